"""Format-preserving pseudonyms for personal data, as DataFrame expressions.

Numbers, dates and similar values in a text are found by pattern, validated,
and replaced by a keyed permutation of the same format: card numbers keep their
length, separators and a right check digit, dates stay dates, addresses stay
addresses.  The permutation is a Feistel network on the value's digits (or on
its characters, each within its class) with a keyed SHA-512 as round function.
It depends on the kind, the key and the value alone, so equal values get equal
pseudonyms in all documents and stay linked, whatever their separators.

Kinds: email addresses (letters and digits of all but the last label), payment
cards (13 to 19 digits, check digit right), telephone numbers (the ten national
digits), social security numbers (areas 1-665 and 667-899), IPv4 addresses (octets up to
255), dates (ISO, dd.mm.yyyy, mm/dd/yyyy; real days from 1900-01-01 on over
``DATE_SIDE ** 2`` days), access key ids and long hexadecimal secrets.  What
fails its validation stays as it is.

Numbers that stand side by side are one run.  Every value that may begin at any
of its numbers is validated first, and the run is then cut at the valid ones from
left to right; cards of other groups than 4-4-4-4, 4-6-5 or one are looked for in
what these leave.  So a value is found whatever number stands beside it.

A run is handled token by token: each sees the tokens that a value can span, the
first valid value there becomes a mark in front of it, and one pass over the
marked run cuts it.  Time grows with the length of a text, whatever it holds; no
repeated group of a pattern can be gone back into, so none needs a deep stack.

Null texts stay null, empty texts stay empty; a text is handled within its row,
so long texts, repeated rows, ties and hot values need no group at all; an empty
table gives an empty table; other columns are passed through untouched.  The key
comes from a table of one row and stands in no plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.blocks import free_names

#: Rounds of the network.
ROUNDS = 8
#: Days are a pair of numbers below this.
DATE_SIDE = 270
_EPOCH = "1900-01-01"

# The patterns of the kinds, as what comes before, the value and
# what comes after, in order of precedence.
KINDS = {
    "email": (r"(?<![A-Za-z0-9._%+-])", r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", ""),
    "card": (r"(?<![0-9])", r"(?:[0-9]{4}(?<s>[ -])[0-9]{4}\k<s>[0-9]{4}\k<s>[0-9]{4}|[0-9]{4}(?<t>[ -])[0-9]{6}\k<t>[0-9]{5}|[0-9]{13,19})", r"(?![0-9])"),
    "phone": (r"(?<![0-9+])", r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}", r"(?![0-9])"),
    "ssn": (r"(?<![0-9])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?![0-9])"),
    "ip": (r"(?<![0-9.])", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", r"(?![0-9]|\.[0-9])"),
    "iso": (r"(?<![0-9])", r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"(?![0-9])"),
    "dmy": (r"(?<![0-9.])", r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}", r"(?![0-9])"),
    "mdy": (r"(?<![0-9/])", r"[0-9]{2}/[0-9]{2}/[0-9]{4}", r"(?![0-9/])"),
    "loose": (r"(?<![0-9])", r"[0-9](?:[ -]?[0-9]){12,18}", r"(?![0-9])"),
    "keyid": (r"(?<![A-Z0-9])", r"AKIA[A-Z0-9]{16}", r"(?![A-Z0-9])"),
    "hex": (r"(?<![0-9A-Za-z])", r"(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,128}", r"(?![0-9A-Za-z])"),
}
NUMERIC = ("card", "phone", "ssn", "ip", "iso", "dmy", "mdy")
DATES = {"iso": "yyyy-MM-dd", "dmy": "dd.MM.yyyy", "mdy": "MM/dd/yyyy"}
_EMAIL, _KEYID, _HEX = ("".join(KINDS[k]) for k in ("email", "keyid", "hex"))
# Numbers side by side, none of them the beginning of another kind.
_NUMBER = f"(?!{_EMAIL})(?!{_HEX})[0-9]++"
RUN = rf"[(+./-]{{0,3}}+{_NUMBER}(?:[ ().+/-]{{1,3}}+{_NUMBER})*+/?+"
PATTERN = "|".join(f"(?:{p})" for p in (_EMAIL, _KEYID, _HEX, RUN))
#: The shortest value of a run is an address of seven characters.
_SHORTEST = 7


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def permute(values: Column, radix: Column, tweak: Column | str, key: Column | str, back: bool = False) -> Column:
    """Keyed permutation of an array of numbers, position ``i`` below
    ``radix[i]``; radix 1 leaves a position alone.  In each round every second
    position is shifted by a function of the others."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    key, tweak = (F.lit(x) if isinstance(x, str) else x for x in (key, tweak))

    def one(state: Column, r: Column) -> Column:
        others = F.filter(state, lambda v, i: (i % 2) != (r % 2))
        stream = F.sha2(F.concat_ws("|", key, tweak, r.cast("string"), F.size(state).cast("string"),
                                    F.array_join(others.cast("array<string>"), ",")), 512)

        def shifted(s: Column) -> Column:
            def at(v: Column, i: Column) -> Column:
                step = F.conv(F.substring(s, ((i / 2).cast("int") % 21) * 6 + 1, F.lit(6)), 16, 10).cast("int")
                m = F.get(radix, i)
                return F.when((i % 2) != (r % 2), v).otherwise(F.pmod(v - step if back else v + step, m).cast("int"))
            return F.transform(state, at)

        return let(stream, shifted)

    return F.aggregate(rounds, values, one)


def _digits(s: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(s, "[^0-9]", ""), ""), lambda c: c.cast("int"))


def _constant(values: Column, m: int) -> Column:
    return F.transform(values, lambda _: F.lit(m))


def fill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order."""
    chars = F.split(form, "")
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))
    return F.aggregate(chars, start, lambda a, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(a["s"], F.element_at(digits, a["k"]).cast("string")).alias("s"), (a["k"] + 1).alias("k"))
    ).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))), lambda a: a["s"])


def luhn_sum(digits: Column, check: bool = True) -> Column:
    """Luhn sum of digits, the last one being the check digit (``check``) or missing."""
    doubled = 1 if check else 0
    return F.aggregate(F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == doubled, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)),
                       F.lit(0), lambda a, d: a + d)


def _luhn(digits: Column) -> Column:
    return luhn_sum(digits) % 10 == 0


def _fields(s: Column, sep: str) -> Column:
    return F.transform(F.split(s, rf"\{sep}"), lambda c: c.cast("int"))


def _within(f: Column, lows: tuple, sizes: tuple) -> Column:
    return F.forall(F.zip_with(f, F.array(*[F.struct(F.lit(b).alias("b"), F.lit(n).alias("n")) for b, n in zip(lows, sizes)]),
                               lambda v, r: (v >= r["b"]) & (v < r["b"] + r["n"])), lambda ok: ok)


def _day(s: Column, form: str) -> Column:
    """Number of a real day (null: none)."""
    y, m, d = (F.substring(s, form.index(c) + 1, n).cast("int") for c, n in (("y", 4), ("M", 2), ("d", 2)))
    day = F.try_to_date(s, form)
    real = (F.year(day) == y) & (F.month(day) == m) & (F.dayofmonth(day) == d)
    return F.when(real, F.datediff(day, F.lit(_EPOCH).cast("date")))


#: Least values and numbers of values of the fields.
_SSN, _IP = ((1, 1, 1), (898, 99, 9999)), ((0, 0, 0, 0), (256, 256, 256, 256))


def _ssn_fields(s: Column) -> Column:
    """The fields with areas numbered without a gap (666 is none)."""
    return F.transform(_fields(s, "-"), lambda v, i: F.when((i == 0) & (v == 666), F.lit(0)).when((i == 0) & (v > 666), v - 1).otherwise(v))


def _whole(hit: Column, kind: str) -> Column:
    return hit.rlike(f"^(?:{''.join(KINDS[kind])})$")


def _base(c: Column) -> Column:
    """First character of a character's class."""
    return F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65).otherwise(F.ascii(c))


_LABEL = r"\.[A-Za-z0-9-]+$"


def _letters(hit: Column, kind: str) -> Column:
    """The characters of an address or key id that are permuted in their class."""
    return F.split(F.regexp_replace(hit, _LABEL, "") if kind == "email" else F.substring(hit, 5, 16), "")


def _coded(hit: Column) -> Column:
    """``(kind, values, radix)`` of a valid value, null for anything else."""
    def row(kind: str, values: Column, radix: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), values.alias("values"), radix.alias("radix"))

    def tens(kind: str, values: Column) -> Column:
        return let(values, lambda v: row(kind, v, _constant(v, 10)))

    def classes(kind: str) -> Column:
        return let(_letters(hit, kind), lambda chars: row(
            kind, F.transform(chars, lambda c: (F.ascii(c) - _base(c)).cast("int")),
            F.transform(chars, lambda c: F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1))))

    def day(form: str) -> Column:
        return let(_day(hit, form), lambda n: F.when((n >= 0) & (n < DATE_SIDE * DATE_SIDE), row(
            "date", F.array((n / DATE_SIDE).cast("int"), (n % DATE_SIDE).cast("int")), F.array(F.lit(DATE_SIDE), F.lit(DATE_SIDE)))))

    card = let(_digits(hit), lambda d: F.when(_luhn(d), tens("card", F.slice(d, 1, F.size(d) - 1))))
    phone = let(_digits(hit), lambda d: tens("phone", F.slice(d, F.size(d) - 9, 10)))
    ssn = let(_ssn_fields(hit), lambda f: F.when(_within(f, *_SSN), row("ssn", F.transform(f, lambda v: v - 1), F.array(*map(F.lit, _SSN[1])))))
    ip = let(_fields(hit, "."), lambda f: F.when(_within(f, *_IP), row("ip", f, F.array(*map(F.lit, _IP[1])))))
    hexes = let(F.transform(F.split(hit, ""), lambda c: F.conv(c, 16, 10).cast("int")), lambda v: row("hex", v, _constant(v, 16)))
    return (F.when(_whole(hit, "email"), classes("email"))
            .when(_whole(hit, "keyid"), classes("keyid"))
            .when(_whole(hit, "hex"), hexes)
            .when(_whole(hit, "card") | _whole(hit, "loose"), card)
            .when(_whole(hit, "phone"), phone)
            .when(_whole(hit, "ssn"), ssn)
            .when(_whole(hit, "ip"), ip)
            .when(_whole(hit, "iso"), day(DATES["iso"]))
            .when(_whole(hit, "dmy"), day(DATES["dmy"]))
            .when(_whole(hit, "mdy"), day(DATES["mdy"])))


def _written(hit: Column, kind: Column, p: Column) -> Column:
    """Permuted values in the form of the hit."""
    def chars(of: str) -> Column:
        return F.array_join(F.zip_with(p, _letters(hit, of), lambda v, c: F.char((v + _base(c)).cast("bigint"))), "")

    def fields(parts, sep: str) -> Column:
        return F.concat_ws(sep, *[F.lpad(x.cast("string"), w, "0") if w else x.cast("string") for x, w in parts])

    area = F.get(p, F.lit(0)) + 1
    ssn = [(F.when(area > 665, area + 1).otherwise(area), 3), (F.get(p, F.lit(1)) + 1, 2), (F.get(p, F.lit(2)) + 1, 4)]
    day = F.date_add(F.lit(_EPOCH).cast("date"), F.get(p, F.lit(0)) * DATE_SIDE + F.get(p, F.lit(1)))
    date = F.when(hit.contains("-"), F.date_format(day, DATES["iso"])).when(hit.contains("."), F.date_format(day, DATES["dmy"])) \
        .otherwise(F.date_format(day, DATES["mdy"]))
    return (F.when(kind == "email", F.concat(chars("email"), F.regexp_extract(hit, _LABEL, 0)))
            .when(kind == "keyid", F.concat(F.lit("AKIA"), chars("keyid")))
            .when(kind == "hex", F.array_join(F.transform(p, lambda x: F.lower(F.hex(x.cast("bigint")))), ""))
            .when(kind == "card", fill(hit, F.concat(p, F.array(F.pmod(10 - luhn_sum(p, False) % 10, F.lit(10)).cast("int")))))
            .when(kind == "phone", let(_digits(hit), lambda d: fill(hit, F.concat(F.slice(d, 1, F.size(d) - 10), p))))
            .when(kind == "ssn", fields(ssn, "-"))
            .when(kind == "ip", fields([(F.get(p, F.lit(i)), 0) for i in range(4)], "."))
            .otherwise(date))


def pseudonym(hit: Column, key: Column | str, back: bool = False) -> Column:
    """The pseudonym of one found value (``back``: the value of a pseudonym)."""
    return let(_coded(hit), lambda c: F.when(c.isNull(), hit).otherwise(
        let(permute(c["values"], c["radix"], c["kind"], key, back), lambda p: _written(hit, c["kind"], p))))


# ------------------------------------------------------------- runs of numbers
# A number, or one character between numbers.
_TOKEN = "[0-9]++|[^0-9]"
#: Tokens that a value can span (19 single digits and what separates them), and one
#: behind them.
_SPAN = 2 * 19
#: Marks: the character of this number plus n stands before a value of n tokens.
_MARK = 0xE000
_MARKED = "".join(chr(_MARK + n) for n in range(1, _SPAN + 1))
_MARKS = f"[{_MARKED[0]}-{_MARKED[-1]}]"
_CUT = "|".join(f"{chr(_MARK + n)}(?:{_MARKS}?+(?:[0-9]++|[^0-9{_MARKS[1:-1]}])){{{n}}}+" for n in range(1, _SPAN + 1))
_ANY = "|".join("".join(KINDS[k]) for k in NUMERIC)


def _valid(hit: Column, kind: str) -> Column:
    """Whether a hit of the kind is one by its value, too."""
    if kind == "phone":
        return F.lit(True)
    if kind in DATES:
        return F.coalesce(_day(hit, DATES[kind]).between(0, DATE_SIDE * DATE_SIDE - 1), F.lit(False))
    if kind == "ssn":
        return _within(_ssn_fields(hit), *_SSN)
    if kind == "ip":
        return _within(_fields(hit, "."), *_IP)
    return _luhn(_digits(hit))


def _first_valid(near: Column, kinds) -> Column:
    """The value of the first of the ``kinds`` that begins behind the first character
    of ``near`` and is valid (null: none)."""
    def one(kind: str, value: str) -> Column:
        before, _, after = KINDS[kind]
        return let(F.regexp_extract(near, f"^(?s:.){before}({value}){after}", 1),
                   lambda h: F.when(h != "", F.when(_valid(h, kind), h)))
    return F.coalesce(*[one(k, v) for k, v in kinds])


def _piece(s: Column, value: bool) -> Column:
    return F.struct(s.alias("s"), F.lit(value).alias("v"))


def _cut(s: Column, guard: str, kinds, rest) -> Column:
    """Pieces ``(s, v)`` of ``s`` in order: its values (``v``) and what ``rest`` makes
    of the text between them."""
    def marked(tokens: Column) -> Column:
        def mark(near: Column) -> Column:
            value = F.when(near.rlike(f"^(?s:.)(?:{guard})"), _first_valid(near, kinds))
            return let(value, lambda h: F.when(h.isNull(), "").otherwise(
                F.substring(F.lit(_MARKED), F.size(F.regexp_extract_all(h, F.lit(_TOKEN), F.lit(0))), F.lit(1))))

        def one(t: Column, i: Column) -> Column:
            behind = F.when(i > 0, F.right(F.get(tokens, i - 1), F.lit(1))).otherwise(F.lit(" "))
            near = F.concat(behind, F.array_join(F.slice(tokens, i + 1, _SPAN + 1), ""))
            return F.when(t.rlike("^[0-9(+]"), F.concat(let(near, mark), t)).otherwise(t)
        return F.array_join(F.transform(tokens, one), "")

    def pieces(m: Column) -> Column:
        def plain(x: Column) -> Column:
            return F.regexp_replace(x, _MARKS, "")

        gaps = F.transform(F.split(m, _CUT, -1), lambda x: rest(plain(x)))
        values = F.transform(F.regexp_extract_all(m, F.lit(_CUT), F.lit(0)), lambda x: F.array(_piece(plain(x), True)))
        return F.flatten(F.zip_with(gaps, values, lambda g, v: F.when(v.isNull(), g).otherwise(F.concat(g, v))))

    return let(let(F.regexp_extract_all(s, F.lit(_TOKEN), F.lit(0)), marked), pieces)


def _pieces(hit: Column) -> Column:
    """Pieces of a hit of ``PATTERN``."""
    def kept(g: Column) -> Column:
        return F.array(_piece(g, False))

    def loose(g: Column) -> Column:
        # The longest of the valid ones that begin at a number.
        kinds = [("loose", rf"[0-9](?:[ -]?[0-9]){{{n - 1}}}") for n in range(19, 12, -1)]
        return F.when(F.length(g) > 12, _cut(g, "(?<![0-9])[0-9](?:[ -]?[0-9]){12}", kinds, kept)).otherwise(kept(g))

    run = _cut(hit, _ANY, [(k, KINDS[k][1]) for k in NUMERIC], loose)
    return (F.when(~hit.rlike(f"^(?:{RUN})$"), F.array(_piece(hit, True)))
            .when(F.length(hit) >= _SHORTEST, run).otherwise(kept(hit)))


def pseudonymize(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced; ``count`` names a
    column for the number of values that changed.

    The text is cut at the found values and put together again in its row."""
    hits, named, secret = free_names(docs, "__hits", "__named", "__key")
    whole = F.col(text).cast("string")
    out = docs.withColumn(secret, docs.sparkSession.createDataFrame([(key,)], "key string").scalar())
    out = out.withColumn(hits, F.regexp_extract_all(whole, F.lit(PATTERN), F.lit(0)))

    def shown(p: Column) -> Column:
        new = F.when(p["v"], pseudonym(p["s"], F.col(secret))).otherwise(p["s"])
        return let(new, lambda v: F.struct(v.alias("s"), (v != p["s"]).cast("int").alias("n")))

    def joined(ps: Column) -> Column:
        return F.struct(F.array_join(ps["s"], "").alias("s"), F.aggregate(ps["n"], F.lit(0), lambda a, x: a + x).alias("n"))

    out = out.withColumn(named, F.when(F.size(hits) > 0, F.transform(hits, lambda h: let(F.transform(_pieces(h), shown), joined))))
    gaps = F.split(whole, PATTERN, -1)
    new = F.array_join(F.zip_with(gaps, F.col(named)["s"], lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))), "")
    if count:
        changed = F.coalesce(F.aggregate(F.col(named)["n"], F.lit(0), lambda a, x: a + x), F.lit(0))
        out = out.withColumn(count, changed.cast("bigint"))
    return out.withColumn(text, F.when(F.size(hits) > 0, new).otherwise(whole)).drop(hits, named, secret)
