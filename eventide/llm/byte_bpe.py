"""Byte-level BPE encoding and decoding with padded matrices.

The different pieces of a block of texts are grouped by length into padded
numpy matrices of token ids.  In each round every row merges its leftmost pair
of the least rank; pairs are looked up in an open-addressing hash table, rows
close the gap, and rows without a pair leave the matrix.  Very long pieces go
through the same merges with a heap, which keeps their cost near linear.
Decoding gathers the bytes of the ids from one flat table.

Null texts count as empty, empty texts have no ids, a repeated row is encoded
like any other, an empty table gives an empty table, and other columns of the
input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from eventide.llm import pieces as P
from eventide.llm.blocks import gather_runs, text_blocks

#: Pieces of more bytes than this are merged with a heap.
MATRIX_BYTES = 256
_NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Merges and bytes of a byte-level BPE vocabulary.

    ``pairs`` maps (left id, right id) to (rank, merged id)."""

    def __init__(self, token_bytes: list[bytes], left, right, rank, merged, special: dict[str, int] | None = None):
        self.special = special or {}
        self.token_bytes = token_bytes
        size = len(token_bytes)
        self.token_len = np.fromiter(map(len, token_bytes), dtype=np.int64, count=size)
        self.token_at = np.concatenate([[0], np.cumsum(self.token_len)])
        self.flat = np.frombuffer(b"".join(token_bytes) or b"\0", dtype=np.uint8)
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i, b in enumerate(token_bytes):
            if len(b) == 1:
                self.byte_id[b[0]] = i
        self.left = np.asarray(left, dtype=np.int64)
        self.right = np.asarray(right, dtype=np.int64)
        self.rank = np.asarray(rank, dtype=np.int32)
        self.merged = np.asarray(merged, dtype=np.int32)
        self._build()

    def _build(self) -> None:
        n = max(len(self.left), 1)
        self.bits = max(4, int(np.ceil(np.log2(n))) + 2)
        self.slots = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << self.bits, dtype=np.int32)
        keys = (self.left << 20) | self.right
        todo, step = np.arange(len(keys)), 0
        while len(todo):
            at = self._slot(keys[todo], step)
            free = self.slots[at] < 0
            cand, cat = todo[free], at[free]
            self.slots[cat] = keys[cand]           # of several for a slot one stays
            won = self.slots[cat] == keys[cand]
            self.values[cat[won]] = cand[won]
            done = np.zeros(len(keys), dtype=bool)
            done[cand[won]] = True
            todo, step = todo[~done[todo]], step + 1
        self.probes = max(step, 1)

    def _slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        h = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)
        return (h.astype(np.int64) + step) & ((1 << self.bits) - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair among the merges, -1 where there is none."""
        keys = (left.astype(np.int64) << 20) | right
        out = np.full(len(keys), -1, dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        for step in range(self.probes):
            if not len(todo):
                break
            at = self._slot(keys[todo], step)
            held = self.slots[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            todo = todo[~hit & (held >= 0)]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[gather_runs(self.token_at[ids], self.token_len[ids])].tobytes()


def from_tiktoken(raw: bytes) -> Vocabulary:
    """Vocabulary of a rank file: any two tokens whose bytes joined are a token
    merge, at that token's rank."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for b, i in ranks.items():
        tokens[i] = b
    left, right, rank = [], [], []
    for b, i in ranks.items():
        for cut in range(1, len(b)):
            x, y = ranks.get(b[:cut]), ranks.get(b[cut:])
            if x is not None and y is not None:
                left.append(x)
                right.append(y)
                rank.append(i)
    return Vocabulary(tokens, left, right, rank, rank)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in .json vocabularies: printable
    Latin-1 stands for itself, the others follow from U+0100 in byte order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def from_json(raw: bytes) -> Vocabulary:
    """Vocabulary of a byte-level BPE .json file; its special tokens included."""
    spec = json.loads(raw)
    alphabet, vocab = byte_alphabet(), spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
    tokens = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for t, i in vocab.items():
        if t not in special:
            tokens[i] = bytes(alphabet[c] for c in t)
    for t, i in special.items():
        tokens[i] = t.encode()
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return Vocabulary(tokens, [vocab[a] for a, _ in merges], [vocab[b] for _, b in merges],
                      range(len(merges)), [vocab[a + b] for a, b in merges], special)


def load(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        raw = f.read()
    return from_json(raw) if path.endswith(".json") else from_tiktoken(raw)


def share(spark: SparkSession, path: str):
    """The file's bytes as a broadcast (about a megabyte), read once on the
    driver, and the function that builds the vocabulary in a task."""
    with open(path, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())
    build = from_json if path.endswith(".json") else from_tiktoken
    return lambda: build(raw.value)


def _merge_matrix(ids: np.ndarray, vocab: Vocabulary):
    """Merge all rows of a matrix without padding inside (-1 behind a row's
    end); yields ``(rows, lengths, matrix)`` of finished rows."""
    rows = np.arange(len(ids))
    found = vocab.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
    rank_of = np.append(vocab.rank, _NONE)         # index -1: no merge
    while len(rows):
        ranks = rank_of[found]
        at = ranks.argmin(axis=1)                   # the first of equals: leftmost
        line = np.arange(len(rows))
        open_ = ranks[line, at] != _NONE
        if not open_.all():
            done = ~open_
            yield rows[done], (ids[done] >= 0).sum(axis=1), ids[done]
            rows, ids, found, at = rows[open_], ids[open_], found[open_], at[open_]
            if not len(rows):
                return
            line = np.arange(len(rows))
        merged = vocab.merged[found[line, at]]
        cols = np.arange(ids.shape[1])
        shifted = np.empty_like(ids)
        shifted[:, :-1], shifted[:, -1] = ids[:, 1:], -1
        ids = np.where(cols > at[:, None], shifted, ids)
        ids[line, at] = merged
        if found.shape[1] > 1:
            shifted = np.empty_like(found)
            shifted[:, :-1], shifted[:, -1] = found[:, 1:], -1
            found = np.where(cols[:-1] > at[:, None], shifted, found)
        # Pairs beside the new token.
        right = np.where(at + 1 < ids.shape[1], ids[line, np.minimum(at + 1, ids.shape[1] - 1)], -1)
        inside = at < found.shape[1]
        found[line[inside], at[inside]] = vocab.find(merged[inside], right[inside])
        has = at > 0
        found[line[has], at[has] - 1] = vocab.find(ids[line[has], at[has] - 1], merged[has])
        width = int((ids >= 0).sum(axis=1).max())
        if width < ids.shape[1]:
            ids, found = ids[:, :max(width, 2)], found[:, :max(width, 2) - 1]


def _merge_heap(piece: bytes, vocab: Vocabulary, table: dict) -> list[int]:
    """The same merges for one long piece: a heap of (rank, position)."""
    ids = [int(vocab.byte_id[b]) for b in piece]
    n = len(ids)
    nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def push(i: int) -> None:
        j = nxt[i]
        if j < n and (hit := table.get((ids[i], ids[j]))):
            heapq.heappush(heap, (hit[0], i, ids[i], ids[j], hit[1]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = nxt[i] if ids[i] == a else n
        if j >= n or ids[j] != b:
            continue
        ids[i], ids[j], nxt[i] = new, -1, nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        if prev[i] >= 0:
            push(prev[i])
        push(i)
    return [x for x in ids if x >= 0]


def encode_pieces(p: P.Pieces, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the different pieces: ``(offsets, ids)``."""
    count = len(p.uniq_len)
    lens = np.zeros(count, dtype=np.int64)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    plain = ~p.special
    low = 0
    for high in (1, 2, 4, 6, 8, 10, 12, 16, 24, 32, 64, 128, MATRIX_BYTES):
        of = np.flatnonzero(plain & (p.uniq_len > low) & (p.uniq_len <= high))
        low = high
        for some in np.array_split(of, max(1, len(of) * high // 2_000_000 + 1)):
            if not len(some):
                continue
            cols = np.arange(high)
            at = np.minimum(p.uniq_start[some][:, None] + cols, len(p.data) - 1)
            ids = np.where(cols < p.uniq_len[some][:, None], vocab.byte_id[p.data[at]], np.int32(-1))
            if high == 1:
                done.append((some, np.ones(len(some), np.int64), ids))
                continue
            done.extend((some[r], n, m) for r, n, m in _merge_matrix(ids, vocab))
    longer = np.flatnonzero(plain & (p.uniq_len > MATRIX_BYTES))
    if len(longer):
        table = {(a, b): (r, m) for a, b, r, m in zip(vocab.left.tolist(), vocab.right.tolist(), vocab.rank.tolist(), vocab.merged.tolist())}
        for k in longer.tolist():
            ids = np.array(_merge_heap(p.piece(k), vocab, table), dtype=np.int32)
            done.append((np.array([k]), np.array([len(ids)]), ids[None, :]))
    for k in np.flatnonzero(p.special).tolist():
        done.append((np.array([k]), np.array([1]), np.array([[vocab.special[p.piece(k).decode()]]], dtype=np.int32)))
    for rows, n, _ in done:
        lens[rows] = n
    offsets = np.concatenate([[0], np.cumsum(lens)])
    flat = np.zeros(int(offsets[-1]), dtype=np.int32)
    for rows, n, m in done:
        cols = np.arange(m.shape[1])
        keep = cols < n[:, None]
        flat[(offsets[rows][:, None] + cols)[keep]] = m[keep]
    return offsets, flat


def encode_block(texts: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of a block of texts: ``(offsets per text, ids)``."""
    special = next(iter(vocab.special), None)
    if len(vocab.special) > 1:
        raise ValueError("more than one special token is not supported")
    p = P.split(texts, special)
    offsets, flat = encode_pieces(p, vocab)
    lens = np.diff(offsets)
    per_piece = lens[p.codes]
    ids = flat[gather_runs(offsets[:-1][p.codes], per_piece)]
    ends = np.concatenate([[0], np.cumsum(per_piece)])
    return ends[p.doc_at], ids


def encode(df: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, ids array<int>)`` of every text."""
    build = share(df.sparkSession, vocab_path)

    def run(batches):
        vocab = build()
        for batch, texts in text_blocks(batches, "t"):
            at, ids = encode_block(texts, vocab)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))], names=[key, "ids"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t").mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(df: DataFrame, vocab_path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``(key, data binary)``: the bytes of each row's ids (null ids: empty)."""
    build = share(df.sparkSession, vocab_path)

    def run(batches):
        vocab = build()
        for batch in batches:
            out = [vocab.decode(np.asarray(x if x is not None else [], dtype=np.int64)) for x in batch.column("i").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(out, pa.binary())], names=[key, "data"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.selectExpr(f"`{key}` as k", f"`{ids}` as i").mapInArrow(run, f"`{key}` {kind}, data binary")


def _decimal(ids: np.ndarray, words: np.ndarray) -> bytes:
    return b",".join(words[ids].tolist())


def digests(df: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode, decode again, and keep digests only: ``(key, n_tokens,
    ids_sha256, decoded_sha256)``; ids never leave the task."""
    build = share(df.sparkSession, vocab_path)

    def run(batches):
        vocab = build()
        words = np.array([str(i).encode() for i in range(len(vocab.token_bytes))], dtype=object)
        for batch, texts in text_blocks(batches, "t"):
            at, ids = encode_block(texts, vocab)
            decoded = vocab.decode(ids)
            byte_at = np.concatenate([[0], np.cumsum(vocab.token_len[ids])])[at]
            sha_ids, sha_out = [], []
            for a, b, x, y in zip(at.tolist(), at[1:].tolist(), byte_at.tolist(), byte_at[1:].tolist()):
                sha_ids.append(hashlib.sha256(_decimal(ids[a:b], words)).hexdigest())
                sha_out.append(hashlib.sha256(decoded[x:y]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(np.diff(at), pa.int64()), pa.array(sha_ids, pa.string()), pa.array(sha_out, pa.string())],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t").mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
