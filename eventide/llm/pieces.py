"""Vectorised pre-tokenizer for the byte-level BPE vocabularies.

Splits texts as the pattern of the vocabularies does (contractions, an
optional space before a run of letters, numbers or other marks, white space
that leaves its last character to the next word), as array operations over
all code points of a block of texts.  Equal pieces are numbered once, so the
encoders see each different piece of a block a single time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex

from eventide.llm.blocks import gather_runs

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
_CLASSES = None
#: Zero bytes behind a block's data, for reads of whole words.
PAD = 32
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def char_classes() -> np.ndarray:
    """Class of every code point under the pattern (built once per worker)."""
    global _CLASSES
    if _CLASSES is None:
        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
        text = points.astype("<u4").tobytes().decode("utf-32-le")
        table = np.full(0x110000, _OTHER, dtype=np.uint8)
        for pattern, kind in ((r"\p{L}+", _LETTER), (r"\p{N}+", _NUMBER), (r"\s+", _SPACE)):
            for m in regex.finditer(pattern, text):
                table[points[m.start():m.end()]] = kind
        _CLASSES = table
    return _CLASSES


@dataclass
class Pieces:
    """Pieces of a block of texts.

    ``codes`` numbers the pieces in text order, ``doc_at`` gives each text's
    first piece (one entry more than texts).  ``uniq_start``/``uniq_len`` place
    each different piece in ``data`` (UTF-8).  ``special`` marks different
    pieces that stand for a special token.
    """

    data: np.ndarray
    codes: np.ndarray
    lengths: np.ndarray
    doc_at: np.ndarray
    uniq_start: np.ndarray
    uniq_len: np.ndarray
    special: np.ndarray
    starts: np.ndarray

    def piece(self, k: int) -> bytes:
        s = int(self.uniq_start[k])
        return self.data[s:s + int(self.uniq_len[k])].tobytes()


def _starts(cp: np.ndarray, seg_at: np.ndarray) -> np.ndarray:
    """Flags of the code points that begin a piece; segments begin at ``seg_at``."""
    n = len(cp)
    cls = char_classes()[cp]
    first = np.zeros(n + 1, dtype=bool)
    first[seg_at] = True
    start = first[:n].copy()
    start[1:] |= cls[1:] != cls[:-1]
    same = ~first[1:]                          # the next code point is of the same segment
    nxt = np.empty(n, dtype=np.uint8)
    nxt[:-1], nxt[-1] = cls[1:], _SPACE
    last_space = (cls == _SPACE) & same & (nxt != _SPACE)
    start |= last_space
    joined = np.flatnonzero(last_space & (cp == 0x20)) + 1
    start[joined] = False
    quote = np.flatnonzero((cp == 0x27) & start & same & (nxt == _LETTER))
    if len(quote):
        padded = np.concatenate([cp, np.zeros(3, cp.dtype)])
        a, b = padded[quote + 1], padded[quote + 2]
        two_in = same[np.minimum(quote + 1, n - 1)]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = two_in & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e")))
                        | ((a == ord("l")) & (b == ord("l"))))
        for hit, width in ((quote[one], 2), (quote[two], 3)):
            start[hit + 1] = False
            after = hit + width
            inside = after < n
            after = after[inside]
            after = after[(cls[after] == _LETTER)]
            start[after] = True
    return start


def split(texts: list[str], special: str | None = None) -> Pieces:
    """Cut ``texts`` into pieces.  ``special`` is a string that counts as one
    token wherever it stands (and ends the piece before it)."""
    if special and any(special in t for t in texts):
        segments, doc_first, marks = [], [], []
        for t in texts:
            doc_first.append(len(segments))
            for k, part in enumerate(t.split(special)):
                if k:
                    marks.append(len(segments))
                    segments.append(special)
                segments.append(part)
        doc_first.append(len(segments))
    else:
        segments, doc_first, marks = texts, list(range(len(texts) + 1)), []
    joined = "".join(segments)
    cp = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
    raw = joined.encode()
    data = np.zeros(len(raw) + PAD, dtype=np.uint8)
    data[:len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    seg_len = np.fromiter(map(len, segments), dtype=np.int64, count=len(segments))
    seg_at = np.concatenate([[0], np.cumsum(seg_len)])
    n = len(cp)
    if not n:
        zero = np.zeros(0, np.int64)
        return Pieces(data, zero, zero, np.zeros(len(texts) + 1, np.int64), zero, zero, zero.astype(bool), zero)
    flags = _starts(cp, seg_at)
    for m in marks:
        flags[seg_at[m] + 1:seg_at[m + 1]] = False
    at = np.flatnonzero(flags)
    doc_at = np.searchsorted(at, seg_at[doc_first])
    if len(raw) == n:
        begin = at.astype(np.int64)
    else:
        width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
        begin = (np.cumsum(width) - width)[at]
    length = np.diff(begin, append=len(raw))
    codes, u_start, u_len = number(data, begin, length)
    is_special = np.zeros(len(u_start), dtype=bool)
    if marks:
        # A marked piece gets a number of its own even if the same bytes occur unmarked.
        of = np.searchsorted(at, seg_at[marks])
        codes = codes.copy()
        codes[of] = len(u_start)
        u_start = np.append(u_start, begin[of[0]])
        u_len = np.append(u_len, length[of[0]])
        is_special = np.append(is_special, True)
    return Pieces(data, codes, length, doc_at, u_start, u_len, is_special, begin)


def number(data: np.ndarray, begin: np.ndarray, length: np.ndarray):
    """Number equal byte ranges alike: ``(codes, first start, length)`` of the
    different ones.  Ranges of up to 16 bytes are compared as two words, longer
    ones as bytes."""
    words = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), shape=(len(data) - 8,), strides=(1,))
    low = words[begin] & _MASK[np.minimum(length, 8)]
    high = words[begin + 8] & _MASK[np.clip(length - 8, 0, 8)]
    long_at = np.flatnonzero(length > 16)
    key = (low * np.uint64(0x9E3779B97F4A7C15)) ^ ((high + length.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F))
    key ^= key >> np.uint64(29)
    if len(long_at):
        seen: dict[bytes, int] = {}
        view = data.tobytes()
        for i in long_at.tolist():
            b = int(begin[i])
            k = seen.setdefault(view[b:b + int(length[i])], i)
            low[i], high[i] = k, 0
            key[i] = (k * 0x9E3779B97F4A7C15 + 0x165667B19E3779F9) % (1 << 64)
    codes, uniq = pd.factorize(key)
    first = np.empty(len(uniq), dtype=np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    at = first[codes]
    if not ((low[at] == low).all() and (high[at] == high).all() and (length[at] == length).all()):
        frame = pd.DataFrame({"l": low, "h": high, "n": length})
        codes = frame.groupby(["l", "h", "n"], sort=False).ngroup().to_numpy()
        first = np.empty(codes.max() + 1, dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, begin[first], length[first]


def concat_runs(starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    return values[gather_runs(starts, lengths)]
