"""Exact token counts of every prefix, by dynamic programming over prefixes.

The BPE form of a prefix is the form of a shorter prefix and one more token
that is compatible with that form's last token.  A token is compatible with the
one before it when no merge across their border comes before the merges that
build the two, which is checked by undoing their merges, latest first.  So one
pass over a piece gives the last token and the count at every position; sums
over the pieces give the counts at every prefix of the text, and with them the
answers to truncation and budget questions, without encoding again.

Different pieces of a block of texts are handled once, rows of like length
together; pieces of over ``MATRIX_BYTES`` bytes one by one.

Three kinds of prefix end inside something that the whole text splits
otherwise, and get a count of their own: inside a contraction, inside white
space before a word, inside a special token's string.

Null texts count as empty (no tokens, prefix list ``[0]``); repeated rows are
counted like any other, an empty table gives an empty table, and other columns
of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventide.llm import byte_bpe, pieces as P
from eventide.llm.blocks import gather_runs, text_blocks

#: Pieces of more bytes than this are counted one by one.
MATRIX_BYTES = 256
_NEVER = np.int64(1) << 40


class PrefixModel:
    """Tokens by their bytes, and the compatibility test of two tokens."""

    def __init__(self, vocab: byte_bpe.Vocabulary):
        self.vocab = vocab
        size = len(vocab.token_bytes)
        self.made_at = np.full(size, -1, dtype=np.int64)       # rank of the merge that makes a token
        self.part_l = np.full(size, -1, dtype=np.int64)
        self.part_r = np.full(size, -1, dtype=np.int64)
        special = set(vocab.special.values())
        # A token reachable from its own bytes; its last merge is the split that
        # the encoder itself makes.
        plain = [i for i, b in enumerate(vocab.token_bytes) if b and i not in special]
        self.ids: dict[bytes, int] = {}
        self.memo: dict[tuple[int, int], bool] = {}
        by_token: dict[int, list[int]] = {}
        for k, m in enumerate(vocab.merged.tolist()):
            by_token.setdefault(m, []).append(k)
        forms = _plain_forms([vocab.token_bytes[i] for i in plain], vocab)
        for i, form in zip(plain, forms):
            if form != [i]:
                continue
            self.ids[vocab.token_bytes[i]] = i
            ks = by_token.get(i, [])
            if len(vocab.token_bytes[i]) > 1:
                k = ks[0] if len(ks) == 1 else self._last_merge(i, ks)
                self.made_at[i] = vocab.rank[k]
                self.part_l[i], self.part_r[i] = vocab.left[k], vocab.right[k]
        self.longest = max(map(len, self.ids), default=1)
        self._build()

    def _last_merge(self, token: int, ks: list[int]) -> int:
        """Which of several merges makes the token from its own bytes: the one
        whose parts are what is left before the last merge."""
        v = self.vocab
        ids = [int(v.byte_id[b]) for b in v.token_bytes[token]]
        table = self.__dict__.setdefault("_pairs", {
            (a, b): (r, m) for a, b, r, m in zip(v.left.tolist(), v.right.tolist(), v.rank.tolist(), v.merged.tolist())})
        while len(ids) > 2:
            at = min(range(len(ids) - 1), key=lambda i: (table.get((ids[i], ids[i + 1]), (_NEVER,))[0], i))
            ids[at:at + 2] = [table[ids[at], ids[at + 1]][1]]
        return next(k for k in ks if [int(v.left[k]), int(v.right[k])] == ids)

    def _build(self) -> None:
        short = [(b, i) for b, i in self.ids.items() if len(b) <= 16]
        raw = np.frombuffer(b"".join(b.ljust(16, b"\0") for b, _ in short), dtype="<u8").reshape(-1, 2)
        self.k_low, self.k_high = raw[:, 0].copy(), raw[:, 1].copy()
        self.k_len = np.array([len(b) for b, _ in short], dtype=np.int64)
        self.k_id = np.array([i for _, i in short], dtype=np.int64)
        self.bits = max(4, int(np.ceil(np.log2(max(len(short), 1)))) + 2)
        self.slots = np.full(1 << self.bits, -1, dtype=np.int64)
        todo, step = np.arange(len(short)), 0
        while len(todo):
            at = (self._hash(self.k_low[todo], self.k_high[todo], self.k_len[todo]) + step) & (len(self.slots) - 1)
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            todo, step = todo[self.slots[at] != todo], step + 1
        self.probes = step

    def _hash(self, low, high, length) -> np.ndarray:
        h = (low ^ (high * np.uint64(0xC2B2AE3D27D4EB4F)) ^ np.asarray(length).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def token(self, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
        """Id of the token with these bytes, -1 where there is none."""
        out = np.full(len(low), -1, dtype=np.int64)
        base, todo = self._hash(low, high, np.int64(length)), np.arange(len(low))
        for step in range(self.probes):
            if not len(todo):
                break
            k = self.slots[(base[todo] + step) & (len(self.slots) - 1)]
            hit = (k >= 0) & (self.k_low[k] == low[todo]) & (self.k_high[k] == high[todo]) & (self.k_len[k] == length)
            out[todo[hit]] = self.k_id[k[hit]]
            todo = todo[~hit & (k >= 0)]
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the encoder leaves each (left, right) as these two tokens."""
        good = np.zeros(len(left), dtype=bool)
        at = np.arange(len(left))
        a, b = left.astype(np.int64), right.astype(np.int64)
        limit = np.full(len(at), _NEVER)           # when the later of the two was joined to its neighbour
        from_right = np.zeros(len(at), dtype=bool)
        rank = np.append(self.vocab.rank.astype(np.int64), _NEVER + 1)
        while len(at):
            cross = rank[self.vocab.find(a, b)]
            fine = (cross > limit) | ((cross == limit) & ~from_right)
            ra, rb = self.made_at[a], self.made_at[b]
            ends = fine & (ra < 0) & (rb < 0)
            good[at[ends]] = True
            go = fine & ~ends
            at, a, b, ra, rb = at[go], a[go], b[go], ra[go], rb[go]
            undo_left = ra > rb                     # of equal merges the left one was first
            limit = np.where(undo_left, ra, rb)
            from_right = ~undo_left
            a, b = np.where(undo_left, self.part_r[a], a), np.where(undo_left, b, self.part_l[b])
        return good

    def long_piece(self, piece: bytes) -> np.ndarray:
        """Counts at every byte of one piece."""
        longest, memo = self.longest, self.memo
        if len(memo) > 500_000:
            memo.clear()
        last, count = [0] * (len(piece) + 1), np.zeros(len(piece) + 1, dtype=np.int64)
        for j in range(1, len(piece) + 1):
            for width in range(1, min(j, longest) + 1):
                t = self.ids.get(piece[j - width:j])
                if t is None:
                    continue
                if width < j:
                    pair = (last[j - width], t)
                    ok = memo.get(pair)
                    if ok is None:
                        ok = memo[pair] = bool(self.compatible(np.array([pair[0]]), np.array([t]))[0])
                    if not ok:
                        continue
                last[j], count[j] = t, count[j - width] + 1
                break
        return count[1:]

    def _rows(self, data: np.ndarray, start: np.ndarray, n: np.ndarray, width_max: int) -> np.ndarray:
        """Counts at bytes 0 .. ``width_max`` of pieces ordered by falling length."""
        words = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), shape=(len(data) - 8,), strides=(1,))
        last = np.full((len(start), width_max + 1), -1, dtype=np.int64)
        count = np.zeros((len(start), width_max + 1), dtype=np.int32)
        for j in range(1, width_max + 1):
            todo = np.arange(int(np.searchsorted(-n, -j, side="right")))     # rows with a byte j
            for width in range(1, min(j, self.longest) + 1):
                if not len(todo):
                    break
                o = j - width
                if width <= 16:
                    lo = words[start[todo] + o] & P._MASK[min(width, 8)]
                    hi = words[start[todo] + o + 8] & P._MASK[width - 8] if width > 8 else np.zeros_like(lo)
                    t = self.token(lo, hi, width)
                else:
                    t = np.array([self.ids.get(data[s + o:s + j].tobytes(), -1) for s in start[todo].tolist()], dtype=np.int64)
                is_token = np.flatnonzero(t >= 0)
                if o and len(is_token):
                    is_token = is_token[self.compatible(last[todo[is_token], o], t[is_token])]
                rows = todo[is_token]
                last[rows, j] = t[is_token]
                count[rows, j] = count[rows, o] + 1
                left = np.ones(len(todo), dtype=bool)
                left[is_token] = False
                todo = todo[left]
        return count

    def counts(self, p: P.Pieces) -> tuple[np.ndarray, np.ndarray]:
        """``(offsets, counts)``: counts at every byte position of every
        different piece."""
        offsets = np.concatenate([[0], np.cumsum(p.uniq_len)])
        out = np.zeros(int(offsets[-1]), dtype=np.int32)
        low = 0
        for high in (1, 2, 4, 8, 12, 16, 24, 32, 64, 128, MATRIX_BYTES):
            of = np.flatnonzero((p.uniq_len > low) & (p.uniq_len <= high) & ~p.special)
            low = high
            for some in np.array_split(of, max(1, len(of) * high // 2_000_000 + 1)):
                if not len(some):
                    continue
                some = some[np.argsort(-p.uniq_len[some], kind="stable")]
                n = p.uniq_len[some]
                count = self._rows(p.data, p.uniq_start[some], n, high)
                cols = np.arange(1, high + 1)
                keep = cols <= n[:, None]
                out[(offsets[some][:, None] + cols - 1)[keep]] = count[:, 1:][keep]
        for k in np.flatnonzero((p.uniq_len > MATRIX_BYTES) & ~p.special).tolist():
            out[offsets[k]:offsets[k + 1]] = self.long_piece(p.piece(k))
        for k in np.flatnonzero(p.special).tolist():
            out[offsets[k]:offsets[k + 1]] = 1
        return offsets, out


def _plain_forms(pieces: list[bytes], vocab: byte_bpe.Vocabulary) -> list[list[int]]:
    """Encoder output of byte strings taken as whole pieces."""
    size = np.array([len(b) for b in pieces], dtype=np.int64)
    data = np.zeros(int(size.sum()) + P.PAD, dtype=np.uint8)
    data[:int(size.sum())] = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    start = np.cumsum(size) - size
    empty = np.zeros(0, np.int64)
    p = P.Pieces(data, empty, empty, empty, start, size, np.zeros(len(size), bool), start)
    at, ids = byte_bpe.encode_pieces(p, vocab)
    flat = ids.tolist()
    return [flat[a:b] for a, b in zip(at.tolist(), at[1:].tolist())]


def prefix_block(texts: list[str], model: PrefixModel) -> tuple[np.ndarray, np.ndarray]:
    """Token counts at every code point prefix (0 and whole text included) of a
    block of texts: ``(offsets per text, counts)``."""
    special = next(iter(model.vocab.special), None)
    p = P.split(texts, special)
    offsets, flat = model.counts(p)
    total = flat[offsets[1:] - 1] if len(p.uniq_len) else np.zeros(0, np.int32)
    per_piece = total[p.codes].astype(np.int64)
    base = np.concatenate([[0], np.cumsum(per_piece)])
    doc_of = np.repeat(np.arange(len(texts)), np.diff(p.doc_at))
    base = base[:-1] - base[p.doc_at[:-1]][doc_of]          # tokens of the text before each piece
    size = len(p.data) - P.PAD
    at_byte = flat[gather_runs(offsets[:-1][p.codes], p.lengths)] + np.repeat(base, p.lengths)
    _mend(p, model, base, doc_of, at_byte)
    ends_char = np.ones(size, dtype=bool)                    # byte positions at which a code point ends
    ends_char[:-1] = (p.data[1:size] & 0xC0) != 0x80
    byte_len = np.fromiter((len(t.encode()) for t in texts), dtype=np.int64, count=len(texts))
    chars = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    at = np.concatenate([[0], np.cumsum(chars + 1)])
    out = np.zeros(int(at[-1]), dtype=np.int32)
    out[gather_runs(at[:-1] + 1, chars)] = at_byte[ends_char]
    assert int(byte_len.sum()) == size
    return at, out


def _mend(p: P.Pieces, model: PrefixModel, base, doc_of, at_byte) -> None:
    """Counts at the prefixes that end inside something split otherwise."""
    cls = P.char_classes()
    first = p.data[p.starts]
    # Inside 're, 've, 'll: the apostrophe and one letter are two pieces.
    three = np.flatnonzero((p.lengths == 3) & (first == 0x27))
    if len(three):
        second = p.data[p.starts[three] + 1]
        hit = three[np.isin(second, [ord("r"), ord("v"), ord("l")])]
        at_byte[p.starts[hit] + 1] = base[hit] + 2
    # White space whose last character the next piece took: together one run.
    if len(p.codes) > 1:
        ascii_space = np.zeros(256, dtype=bool)
        ascii_space[[9, 10, 11, 12, 13, 32]] = True
        # A piece that ends in white space is white space throughout.
        end = p.uniq_start + p.uniq_len
        blank = ascii_space[p.data[end - 1]] & ~p.special
        wide = (p.data[end - 2] == 0xC2) | np.isin(p.data[end - 3], [0xE1, 0xE2, 0xE3])
        for u in np.flatnonzero((p.data[end - 1] >= 0x80) & wide & (p.uniq_len > 1) & ~p.special).tolist():
            blank[u] = cls[ord(p.piece(u).decode()[-1])] == P._SPACE
        begins = ascii_space[first] | np.isin(first, [0xC2, 0xE1, 0xE2, 0xE3])
        maybe = np.flatnonzero((doc_of[1:] == doc_of[:-1]) & blank[p.codes[:-1]] & begins[1:])
    else:
        maybe = np.zeros(0, np.int64)
    memo: dict[tuple[int, bytes], int] = {}
    for k in maybe.tolist():
        code = int(p.codes[k])
        if p.special[p.codes[k + 1]]:
            continue
        s = int(p.starts[k + 1])
        n = 1 + int(p.data[s] >= 0xC0) + int(p.data[s] >= 0xE0) + int(p.data[s] >= 0xF0)
        char = p.data[s:s + n].tobytes()
        if cls[ord(char.decode())] != P._SPACE:
            continue
        value = memo.get((code, char))
        if value is None:
            value = memo[code, char] = int(model.long_piece(p.piece(code) + char)[-1])
        at_byte[s + n - 1] = base[k] + value
    # Inside a special token's string: ordinary text until it is whole.
    for k in np.flatnonzero(p.special[p.codes]).tolist():
        s, n = int(p.starts[k]), int(p.lengths[k])
        before = k > 0 and doc_of[k - 1] == doc_of[k] and not p.special[p.codes[k - 1]]
        head = p.piece(int(p.codes[k - 1])).decode() if before else ""
        start = int(base[k - 1] if before else base[k])
        text = p.data[s:s + n].tobytes().decode()
        at, _ = byte_bpe.encode_block([head + text[:m] for m in range(1, n)], model.vocab)
        at_byte[s:s + n - 1] = start + np.diff(at)


def last_within(at: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Code points of each text's longest prefix of at most ``budget`` tokens."""
    if len(at) < 2:
        return np.zeros(0, np.int64)
    return np.maximum.reduceat(np.where(counts <= budget, np.arange(len(counts)), 0), at[:-1]) - at[:-1]


def prefix_counts(df: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, counts array<int>)``: the token count of the first 0, 1, 2, ...
    code points of every text."""
    build = byte_bpe.share(df.sparkSession, vocab_path)

    def run(batches):
        model = PrefixModel(build())
        for batch, texts in text_blocks(batches, "t"):
            at, counts = prefix_block(texts, model)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(counts, pa.int32()))], names=[key, "counts"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t").mapInArrow(run, f"`{key}` {kind}, counts array<int>")


def budgets(df: DataFrame, vocab_path: str, limit: int = 512, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Answers from the prefix counts: ``(key, n_bytes, n_tokens, over_limit,
    cut_chars)``; ``cut_chars`` code points are the longest prefix within the
    limit."""
    build = byte_bpe.share(df.sparkSession, vocab_path)

    def run(batches):
        model = PrefixModel(build())
        for batch, texts in text_blocks(batches, "t"):
            at, counts = prefix_block(texts, model)
            total = counts[at[1:] - 1].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(total, pa.int64()),
                 pa.array(total > limit, pa.bool_()), pa.array(last_within(at, counts, limit), pa.int64())],
                names=[key, "n_bytes", "n_tokens", "over_limit", "cut_chars"])

    kind = df.select(key).schema[0].dataType.simpleString()
    return df.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t").mapInArrow(
        run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_chars bigint")
