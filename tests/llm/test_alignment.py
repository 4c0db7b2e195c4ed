"""Token alignment against a plain form of its contract."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("eventide.llm.queries")

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from eventide.llm import alignment, queries
from eventide.llm.byte_bpe import byte_alphabet

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
TEXTS = [None, "", "a", "Hello world, hello!", "  two  spaces\n\nand lines\t", "don't <|endoftext|> <s> </s> <unk> <0x41>", "été ß 日本語 😀 ３",
         "lower ▁ one", "x" * 3000, "word " * 5000, "Hello world, hello!", "Hello world, hello!", "\x00 zero", " ", "１２３ ﬁ ligature", "a\r\nb"]


def brute(texts):
    a, b = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a.encode_special_tokens = True
    alphabet = byte_alphabet()
    out, count = [], Counter()
    for text in texts:
        row = dict(n_a=0, n_b=0, n_groups=0, n_links=0, groups_sha256="", links=[])
        out.append(row)
        if not text:
            continue
        raw = (" " + text).encode()
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xb = [bytes(alphabet[c] for c in a.id_to_token(i)) if i != 50256 else b"?" for i in x]
        yb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if b"".join(xb) != raw or b"".join(yb) != raw:
            continue
        xe, ye = np.cumsum(list(map(len, xb))).tolist(), np.cumsum(list(map(len, yb))).tolist()
        cuts = sorted(set(xe) & set(ye))
        shown, begin = [], 0
        for cut in cuts:
            shown.append(",".join(str(i) for i, e in zip(x, xe) if begin < e <= cut) + "|" + ",".join(str(i) for i, e in zip(y, ye) if begin < e <= cut))
            begin = cut
        j = 0
        for i in range(len(x)):
            lo, hi = xe[i] - len(xb[i]), xe[i]
            while j and ye[j - 1] > lo:
                j -= 1
            while j < len(y) and ye[j] - len(yb[j]) < hi:
                if ye[j] > lo:
                    row["links"].append((x[i], y[j]))
                j += 1
        row.update(n_a=len(x), n_b=len(y), n_groups=len(cuts), n_links=len(row["links"]), groups_sha256=hashlib.sha256(";".join(shown).encode()).hexdigest())
        count.update(set(row["links"]))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    for row in out:
        links = row.pop("links")
        row["n_best"] = sum(count[p] == most[p[0]] for p in links)
        row["count_sum"] = sum(count[p] for p in links)
    return out


def check(got, texts, keys):
    want = [(k, *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))) for k, r in zip(keys, brute(texts))]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_alignment_equals_plain_form(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 6000)        # several blocks
    keys = [None if i == 4 else i // 2 for i in range(len(TEXTS))]
    # Extra columns whose names clash with helper columns.
    df = spark.createDataFrame([(k, t, 1, "x", 2) for k, t in zip(keys, TEXTS)], "doc_id bigint, text string, block int, k string, n int")
    check(alignment.align(df, JSON, MODEL), TEXTS, keys)
    assert alignment.align(df.where("false"), JSON, MODEL).collect() == []


def test_registered_query_equals_plain_form(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    check(queries.QUERIES["op12_token_alignment"](spark, SMALL), [r[1] for r in rows], [r[0] for r in rows])


def test_cuts_are_the_common_ends():
    r = random.Random(3)
    for _ in range(300):
        a_ends, b_ends, a_at, b_at, base = [], [], [0], [0], 0
        for _ in range(r.randint(0, 4)):
            size = r.choice([0, 1, 2, 9, 60])
            for ends, at in ((a_ends, a_at), (b_ends, b_at)):
                if size:
                    ends += [base + e for e in sorted(r.sample(range(1, size), r.randint(0, size - 1)))] + [base + size]
                at.append(len(ends))
            base += size
        a, b = np.array(a_ends, dtype=np.int64), np.array(b_ends, dtype=np.int64)
        got = alignment.shared_cuts(a, b, np.array(a_at), np.array(b_at))
        common = sorted(set(a_ends) & set(b_ends))
        assert a[got.a - 1].tolist() == common and b[got.b - 1].tolist() == common
        x, y = alignment.overlaps(a, b)
        start = lambda ends, i: ends[i - 1] if i else 0
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if start(a, i) < b[j] and start(b, j) < a[i]]
        assert list(zip(x.tolist(), y.tolist())) == want
