"""Alignment of the tokens of two tokenizers, and counts of the aligned id pairs.

Both tokenizations are ends on one byte axis.  Where a token of each ends, the
text is cut.  The cuts are found by divide and conquer: an interval of tokens
looks for a common end near its middle (bisecting the other side's ends, then
stepping outwards), is split there, and both halves go on; an interval without a
common end inside is a leaf, a group of tokens that stand for the same bytes.  The
intervals of a level are handled together for a whole block of texts.

Tokens of a group whose byte ranges overlap are linked.  The count of an id pair
is the number of documents that hold it linked.  A block of documents counts its
own pairs first, so that a pair that all documents hold is one row per block; the
counts go back to the blocks, not to the documents.

A is a byte-level BPE (``tokenizers`` file) of space + text, B a piece model
(``sentencepiece`` file), which adds that space itself.  Every byte is a token of A,
so only B's bytes can differ.  Texts that are null or
empty, or whose tokens' bytes of either side differ from space + text, have no
tokens: zeros and an empty string.  Rows are documents of their own, whatever
their key: repeated and null keys need no rule.  A block holds at most
``BLOCK_CHARS`` characters or a single longer text.  An empty table gives an empty
table; columns other than key and text are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm.blocks import gather_runs, text_blocks
from eventide.llm.byte_bpe import encode_block, from_json
from eventide.session import shared_dir

#: Characters whose documents share a block of pair counts.
BLOCK_CHARS = 1_000_000
#: Different words whose ids a task remembers.
KNOWN_WORDS = 300_000
_COMMA, _BAR, _SEMICOLON = 44, 124, 59


@dataclass
class Groups:
    """Groups of two token sequences: group ``g`` ends behind A token ``a[g]`` and
    B token ``b[g]`` (exclusive ends, ascending)."""

    a: np.ndarray
    b: np.ndarray


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> Groups:
    """Leaf groups of texts laid end to end: ``a_ends`` and ``b_ends`` are ascending
    byte ends, text ``t`` has the tokens ``a_at[t]:a_at[t+1]`` and
    ``b_at[t]:b_at[t+1]``, and both sides end together at the end of a text."""
    a0, a1, b0, b1 = a_at[:-1], a_at[1:], b_at[:-1], b_at[1:]
    some = a1 > a0
    a0, a1, b0, b1 = (v[some].astype(np.int64) for v in (a0, a1, b0, b1))
    leaf_a, leaf_b = [], []
    while len(a0):
        cut_a, cut_b = _near_middle(a_ends, b_ends, a0, a1, b0, b1)
        leaf = cut_a < 0
        leaf_a.append(a1[leaf])
        leaf_b.append(b1[leaf])
        a0, a1, b0, b1, cut_a, cut_b = (v[~leaf] for v in (a0, a1, b0, b1, cut_a, cut_b))
        # Both halves side by side: intervals stay in order.
        a0, a1 = np.stack([a0, cut_a], axis=1).ravel(), np.stack([cut_a, a1], axis=1).ravel()
        b0, b1 = np.stack([b0, cut_b], axis=1).ravel(), np.stack([cut_b, b1], axis=1).ravel()
    if not leaf_a:
        return Groups(np.zeros(0, np.int64), np.zeros(0, np.int64))
    return Groups(np.sort(np.concatenate(leaf_a)), np.sort(np.concatenate(leaf_b)))


def _near_middle(a_ends, b_ends, a0, a1, b0, b1):
    """Per interval the token ends (exclusive) of a cut inside it, -1: none.  Token
    ends are tried from the middle outwards."""
    cut_a = np.full(len(a0), -1, dtype=np.int64)
    cut_b = np.full(len(a0), -1, dtype=np.int64)
    # An inner end of either side must exist.
    left = np.flatnonzero((a1 - a0 > 1) & (b1 - b0 > 1))
    step = 0
    while len(left):
        mid = (a0[left] + a1[left] - 1) // 2
        at = mid + (step + 1) // 2 * (1 if step % 2 else -1)
        inside = (at >= a0[left]) & (at < a1[left] - 1)
        here, at = left[inside], at[inside]
        end = a_ends[at]
        found = np.searchsorted(b_ends, end)
        hit = (found < b1[here] - 1) & (b_ends[np.minimum(found, len(b_ends) - 1)] == end)
        cut_a[here[hit]] = at[hit] + 1
        cut_b[here[hit]] = found[hit] + 1
        step += 1
        reach = (step + 1) // 2
        left = left[cut_a[left] < 0]
        left = left[reach <= (a1[left] - a0[left]) // 2 + 1]
    return cut_a, cut_b


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers ``(a, b)`` of all overlapping pairs, in order.

    Each end of either side closes one overlap: of the tokens that hold the byte
    before it.  Their numbers are the ends of their sides before it."""
    size = int(a_ends[-1]) + 1 if len(a_ends) else 1
    a, b = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
    a[a_ends], b[b_ends] = True, True
    ends = np.flatnonzero(a | b)
    return np.cumsum(a)[ends - 1], np.cumsum(b)[ends - 1]


class _Words(dict):
    """Numbers of words; ``new`` lists those that have come since it was cleared."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        self.new.append(word)
        return k


class Sides:
    """The two tokenizers in a task."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece

        self.a = from_json(a_file)
        self.a.special = {}                              # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = np.asarray(self.a.token_len, dtype=np.int64), np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        # Where no piece goes on behind a word's end, no merge does: words are encoded
        # by themselves, each different one once.
        self.words = re.compile(r" +[^ ]*" if not any(re.search("[^▁]▁", p) for p in pieces) else r"(?s:.+)")
        self._forget()

    def _forget(self) -> None:
        # The one known word is a space behind the last word (an empty text has no tokens).
        self.known = _Words()
        self.known[" "] = 0
        self.flat, self.at, self.good = np.array([self.b.piece_to_id("▁")]), np.array([0, 1]), np.array([True])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides, ``(a_at, a_ids, b_at, b_ids)``; none of either for a
        text where the bytes differ."""
        spaced = [" " + t if t else "" for t in texts]
        a_at, a_ids = encode_block(spaced, self.a)
        found = [self.words.findall(t) for t in spaced]
        n_words = np.array([len(words) for words in found])
        code = self._numbers(found, int(n_words.sum()))
        size = np.diff(self.at)[code]
        b_ids = self.flat[gather_runs(self.at[code], size)]
        text_of = np.repeat(np.arange(len(texts)), n_words)
        n_b = np.bincount(text_of, weights=size, minlength=len(texts)).astype(np.int64)
        bad = np.zeros(len(texts), dtype=bool)
        bad[text_of[~self.good[code]]] = True
        bad |= np.array([t != "" for t in spaced]) & ((np.diff(a_at) == 0) | (n_b == 0))
        if bad.any():
            a_ids, b_ids = a_ids[~np.repeat(bad, np.diff(a_at))], b_ids[~np.repeat(bad, n_b)]
            a_at, n_b = np.concatenate([[0], np.cumsum(np.where(bad, 0, np.diff(a_at)))]), np.where(bad, 0, n_b)
        return a_at.astype(np.int64), a_ids.astype(np.int64), np.concatenate([[0], np.cumsum(n_b)]), b_ids

    def _numbers(self, found: list[list[str]], n: int) -> np.ndarray:
        """Numbers of all words; new ones are encoded, and their bytes compared."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        code = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(found)), np.int64, n)
        if new := self.known.new:
            ids = self.b.encode([w[1:] for w in new], num_threads=1)
            table = self.b_bytes
            good = np.array([b"".join([table[i] for i in x]) == w.encode() for w, x in zip(new, ids)])
            more = np.fromiter(itertools.chain.from_iterable(ids), np.int64)
            ends = self.at[-1] + np.cumsum([len(x) for x in ids])
            self.flat, self.at, self.good = np.concatenate([self.flat, more]), np.concatenate([self.at, ends]), np.concatenate([self.good, good])
            new.clear()
        return code


def _digits(size: int) -> np.ndarray:
    """Decimal digits of the numbers below ``size``, right-aligned, zero bytes before."""
    n = np.arange(size)
    width = len(str(max(size - 1, 1)))
    out = np.zeros((size, width), dtype=np.uint8)
    for k in range(width):
        part = n // 10 ** k
        out[:, width - 1 - k] = np.where((part > 0) | (k == 0), 48 + part % 10, 0)
    return out


def shown(a_ids: np.ndarray, b_ids: np.ndarray, groups: Groups, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of the whole block as bytes, each token with the mark
    behind it, and the place behind each A/B token pair's group."""
    na, nb = np.diff(groups.a, prepend=0), np.diff(groups.b, prepend=0)
    ids = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
    marks = np.full(len(ids), _COMMA, dtype=np.uint8)
    begin = np.cumsum(na + nb) - na - nb
    ids[gather_runs(begin, na)] = a_ids
    ids[gather_runs(begin + na, nb)] = b_ids
    marks[begin + na - 1] = _BAR
    marks[begin + na + nb - 1] = _SEMICOLON
    rows = np.empty((len(ids), digits.shape[1] + 1), dtype=np.uint8)
    rows[:, :-1], rows[:, -1] = digits[ids], marks
    used = rows != 0
    return rows[used], np.cumsum(used.sum(axis=1))[begin + na + nb - 1]


def align_block(texts: list[str], sides: Sides, digits: np.ndarray) -> dict:
    """Everything of a block but the corpus counts: per text ``n_a``, ``n_b``,
    ``n_groups``, ``n_links`` and the groups' digest; the block's different pairs
    (``a << 32 | b``) with their numbers of texts; and per text which pairs it links
    how often (``ptr``, ``pair``, ``times``)."""
    a_at, a_ids, b_at, b_ids = sides.encode(texts)
    a_ends, b_ends = np.cumsum(sides.a_len[a_ids]), np.cumsum(sides.b_len[b_ids])
    groups = shared_cuts(a_ends, b_ends, a_at, b_at)
    n = len(texts)
    a_text = np.repeat(np.arange(n), np.diff(a_at))
    n_groups = np.bincount(a_text[groups.a - 1], minlength=n)
    digest = [""] * n
    a, b = np.zeros((2, 0), np.int64)
    if len(groups.a):
        flat, ends = shown(a_ids, b_ids, groups, digits)
        last = np.cumsum(n_groups)
        begin = 0
        view = memoryview(flat)
        for t in np.flatnonzero(n_groups).tolist():
            end = int(ends[last[t] - 1])
            digest[t] = hashlib.sha256(view[begin:end - 1]).hexdigest()
            begin = end
        a, b = overlaps(a_ends, b_ends)
    text = a_text[a]
    codes, pair = np.unique(a_ids[a] << 32 | b_ids[b], return_inverse=True)
    held, times = np.unique(text * max(len(codes), 1) + pair, return_counts=True)
    of, pair = np.divmod(held, max(len(codes), 1))
    return {"n_a": np.diff(a_at), "n_b": np.diff(b_at), "n_groups": n_groups, "n_links": np.bincount(text, minlength=n), "digest": digest,
            "codes": codes, "docs": np.bincount(pair, minlength=len(codes)),
            "ptr": np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]), "pair": pair.astype(np.int32), "times": times.astype(np.int32)}


_BUILT: dict[str, Sides] = {}


def _share(spark, a_path: str, b_path: str):
    """Both files as a broadcast (about two megabytes), and the function that
    builds the tokenizers once per Python worker."""
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(f.read())
    name = hashlib.sha256(b"".join(hashlib.sha256(f).digest() for f in files)).hexdigest()
    raw = spark.sparkContext.broadcast(files)

    def build() -> Sides:
        if name not in _BUILT:
            _BUILT[name] = Sides(*raw.value)
        return _BUILT[name]

    return build


def _blocks(docs: DataFrame, a_path: str, b_path: str, text: str, key: str) -> DataFrame:
    """One row per block: the columns of its texts as lists, and its pairs."""
    build = _share(docs.sparkSession, a_path, b_path)
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches):
        sides = build()
        digits = _digits(max(len(sides.a_len), len(sides.b_len)))
        for batch, texts in text_blocks(batches, "t", BLOCK_CHARS):
            got = align_block(texts, sides, digits)
            keys = batch.column("k")
            columns = [pa.array([keys.to_pylist()], pa.list_(keys.type))]
            columns += [pa.array([got[c]], pa.list_(pa.int64())) for c in ("n_a", "n_b", "n_groups", "n_links")]
            columns += [pa.array([got["digest"]], pa.list_(pa.string())), pa.array([got["codes"]], pa.list_(pa.int64())),
                        pa.array([got["docs"]], pa.list_(pa.int32()))]
            columns += [pa.array([got[c].astype(np.int32).tobytes()], pa.binary()) for c in ("ptr", "pair", "times")]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    schema = (f"k array<{kind}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, digest array<string>, "
              "codes array<bigint>, docs array<int>, ptr binary, pair binary, times binary")
    rows = docs.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t")
    return rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


_NAMES = ["k", "n_a", "n_b", "n_groups", "n_links", "digest", "codes", "docs", "ptr", "pair", "times"]


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(code, n, best)``: documents that hold a pair linked, and whether no other
    pair of its A id is held by more."""
    own = blocks.select(F.inline(F.arrays_zip(F.col("codes").alias("code"), F.col("docs").alias("n"))))
    count = own.groupBy("code").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("code", 32))
    most = count.groupBy("a").agg(F.max("n").alias("most"))
    return count.join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of
    every row; the digest is empty for a text without tokens."""
    spark = docs.sparkSession
    path = shared_dir(spark, "alignment")
    _blocks(docs, a_path, b_path, text, key).write.parquet(path)
    blocks = spark.read.parquet(path)
    own = blocks.select("block", F.posexplode("codes").alias("i", "code"))
    back = own.join(pair_counts(blocks), "code").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("i", "n", "best"))).alias("got"))
    back = back.select("block", F.col("got.n").alias("n"), F.col("got.best").alias("best"))
    joined = blocks.drop("codes", "docs").join(back, "block", "left")
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                one = {c: batch.column(c)[r] for c in batch.schema.names}
                ptr, pair, times = (np.frombuffer(one[c].as_py(), np.int32) for c in ("ptr", "pair", "times"))
                n = np.asarray(one["n"].values if one["n"].is_valid else [], dtype=np.int64)
                best = np.asarray(one["best"].values if one["best"].is_valid else [], dtype=np.int64)
                sums = [np.diff(np.concatenate([[0], np.cumsum(v[pair] * times)])[ptr]) for v in (best, n)]
                lists = {c: one[c].values for c in ("n_a", "n_b", "n_groups", "n_links", "digest")}
                yield pa.RecordBatch.from_arrays(
                    [one["k"].values, *(lists[c] for c in ("n_a", "n_b", "n_groups", "n_links")), *map(pa.array, sums), lists["digest"]],
                    names=[key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return joined.mapInArrow(run, f"`{key}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                                  "count_sum bigint, groups_sha256 string")
