"""Java ``hashCode`` of any scalar.

* string: ``h = 31*h + unit`` over UTF-16 code units, 32-bit wrap-around;
  code points beyond the BMP are expanded to their surrogate pair;
* tinyint, smallint, int: the value; boolean: 1231 or 1237;
* bigint and the bits of a double: ``(int)(v ^ (v >>> 32))``.

Null gives null; other types raise an error.  ``java_hash`` is a native
expression that picks the rule by the column's analysed type (``typeof`` is
folded, so only one rule stays in the plan).  A SQL function has fixed argument
types, so the form called by name (``hash_arrow``) is an Arrow function, which
sees the type of its batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

_M32 = 1 << 32
# Fixed values of the Java rules.
TRUE_HASH, FALSE_HASH = 1231, 1237
NAN_BITS, INFINITY_BITS = 0x7FF8000000000000, 0x7FF0000000000000


def _signed32(h: Column) -> Column:
    return F.when(h >= F.lit(1 << 31), h - F.lit(_M32)).otherwise(h).cast("int")


def _string_hash(s: Column) -> Column:
    cps = F.transform(F.split(s, ""), lambda ch: F.ascii(ch).cast("bigint"))
    units = F.flatten(F.transform(cps, lambda cp: F.when(
        cp >= F.lit(0x10000),
        F.array(F.lit(0xD800) + F.shiftright(cp - F.lit(0x10000), 10),
                F.lit(0xDC00) + ((cp - F.lit(0x10000)) % F.lit(1024))),
    ).otherwise(F.array(cp))))
    h = F.aggregate(units, F.lit(0).cast("bigint"),
                    lambda acc, u: (acc * F.lit(31) + u) % F.lit(_M32))
    return F.when(s == "", F.lit(0)).otherwise(_signed32(h))


def _long_hash(v: Column) -> Column:
    return _signed32(F.pmod(v.bitwiseXOR(F.shiftrightunsigned(v, 32)), F.lit(_M32)))


def _double_bits(x: Column) -> Column:
    """IEEE bits of a double by exact scaling with powers of two."""
    a, two = F.abs(x), F.lit(2.0)
    guess = F.floor(F.log2(a))
    e = F.when(F.pow(two, guess) > a, guess - 1).when(F.pow(two, guess + 1) <= a, guess + 1).otherwise(guess)
    part = F.lit(float(1 << 52))
    normal = F.shiftleft(e + 1023, 52) + ((a / F.pow(two, e) - 1) * part).cast("bigint")
    small = (a * F.lit(2.0 ** 1022) * part).cast("bigint")         # zero and subnormal: exponent field 0
    bits = (F.when(F.isnan(x), F.lit(NAN_BITS)).when(a == float("inf"), F.lit(INFINITY_BITS))
             .when(a < F.lit(2.0 ** -1022), small).otherwise(normal))
    negative = (x < 0) | (x.cast("string") == "-0.0")
    return F.when(negative, bits.bitwiseOR(F.lit(-(1 << 63)))).otherwise(bits)


def java_hash(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """Hash of a column by its type; ``dtype`` names the type to hash it as."""
    col = F.col(c) if isinstance(c, str) else c
    col = col if dtype is None else col.cast(dtype)
    kind, s = F.typeof(col), col.cast("string")      # every rule must type-check for every column
    return (F.when(kind == "string", _string_hash(s))
             .when(kind.isin("tinyint", "smallint", "int"), s.cast("int"))
             .when(kind == "bigint", _long_hash(s.cast("bigint")))
             .when(kind == "boolean", F.when(s == "true", TRUE_HASH).when(s == "false", FALSE_HASH))
             .when(kind == "double", _long_hash(_double_bits(s.cast("double"))))
             .otherwise(F.raise_error(F.concat(F.lit("java_hash: no rule for "), kind)).cast("int")))


def _fold(v: np.ndarray) -> np.ndarray:
    u = v.view(np.uint64)
    return (u ^ (u >> np.uint64(32))).astype(np.uint32).view(np.int32)


def _string_hashes(a: pa.Array) -> np.ndarray:
    """Hash of every different string of the batch, dealt back to its rows."""
    found = a.fill_null("").dictionary_encode()
    units = [np.frombuffer(s.encode("utf-16-le"), "<u2") for s in found.dictionary.to_pylist()]
    powers = np.full(max(map(len, units), default=0) + 1, 31, np.uint32)
    powers[0] = 1
    powers = np.multiply.accumulate(powers, dtype=np.uint32)
    hashes = [(u * powers[:len(u)][::-1]).sum(dtype=np.uint32) for u in units]
    return np.array(hashes, np.uint32).view(np.int32)[found.indices.to_numpy()]


def hash_arrow(a: pa.Array) -> pa.Array:
    """The same rules over an Arrow array of any type."""
    t = a.type
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        out = _string_hashes(a)
    elif t in (pa.int8(), pa.int16(), pa.int32()):
        out = a.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int32)
    elif t == pa.int64():
        out = _fold(a.fill_null(0).to_numpy(zero_copy_only=False))
    elif t == pa.bool_():
        out = np.where(a.fill_null(False).to_numpy(zero_copy_only=False), TRUE_HASH, FALSE_HASH).astype(np.int32)
    elif t == pa.float64():
        x = a.fill_null(0.0).to_numpy(zero_copy_only=False)
        out = _fold(np.where(np.isnan(x), NAN_BITS, x.view(np.int64)))
    else:
        raise TypeError(f"java_hash: no rule for {t}")
    return pa.array(out, pa.int32(), mask=a.is_null().to_numpy(zero_copy_only=False))
