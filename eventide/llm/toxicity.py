"""Toxicity grades by cumulative-link ordinal regression on sparse words.

``P(grade <= k) = sigmoid(theta_k - w . x)`` with thresholds in rising order and
one weight vector for all of them; ``x`` holds ``log(1 + count)`` of a text's
words and word beginnings (4 to 6 letters).  The expected severity is ``sum_k P(grade > k)``.

The labels give 0/1 only, so the grades are made in two steps, both of the same
model: with the two grades of the labels, a fit with an L1 penalty picks the
features that tell toxic texts; the toxic texts are then graded 1, 2 or 3 by thirds
of their number of such features, and the model with three thresholds is fitted
on these.  Both fits use the labelled rows of least hash, at most
``SAMPLE_ROWS`` of them (a documented bound); every document is scored whole.

Null and empty texts have no words and get the grade of that (a toxic reading
needs words); labels without a doc_id or a grade are left out, of repeated ones
the highest counts; without toxic or without clean labels nothing is toxic.
Repeated rows are scored alike, an empty table gives an empty table, and other
columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from eventide.llm.blocks import free_names, text_blocks
from eventide.session import cut_lineage

#: Labelled rows that a fit may use.
SAMPLE_ROWS = 20_000
#: Toxic texts of the sample in which a feature must stand, and the likelihood
#: ratio (twice the logarithm) by which it must tell them from the clean ones.
MIN_TEXTS = 5
RATIO = 12.0
#: L1 penalty of the word choice and L2 penalty of the final fit.
L1 = 0.0002
L2 = 1e-4
GRADES = 4
_WORD = re.compile(r"\w+")


@dataclass
class OrdinalModel:
    """Words with their weights, and the rising thresholds."""

    words: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def scorer(self):
        """Function from texts to their ``w . x``."""
        weight = dict(zip(self.words, self.weights.tolist()))
        split = Features(weight)

        def linear(texts: list[str]) -> np.ndarray:
            return np.array([sum(weight[w] * np.log1p(c) for w, c in sorted(split.count(t).items())) for t in texts], dtype=np.float64)
        return linear

    def score(self, x: np.ndarray) -> np.ndarray:
        """``P(grade > k)`` per threshold for linear scores ``x``."""
        return _sigmoid(x[:, None] - self.thresholds[None, :])


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_thresholds(grades: np.ndarray, levels: int) -> np.ndarray:
    """Thresholds that give the grades' shares without any word."""
    share = np.array([(np.sum(grades <= k) + 0.5) / (len(grades) + 1) for k in range(levels - 1)])
    return np.log(share / (1 - share))


def fit(indptr: np.ndarray, cols: np.ndarray, vals: np.ndarray, size: int, grades: np.ndarray, levels: int,
        l1: float = 0.0, l2: float = 0.0, steps: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised loss (accelerated proximal
    gradient; rows in CSR form)."""
    n = len(grades)
    rows = np.repeat(np.arange(n), np.diff(indptr))
    theta = fit_thresholds(grades, levels)
    # Thresholds as a first one and positive gaps, so that they stay in order.
    gaps = np.concatenate([[theta[0]], np.log(np.maximum(np.diff(theta), 1e-3))])
    w = np.zeros(size)

    def dot(v):
        return np.bincount(rows, weights=vals * v[cols], minlength=n)

    # Step from the largest curvature, by power iteration on the columns.
    v = np.ones(size) / np.sqrt(max(size, 1))
    for _ in range(12):
        u = np.bincount(cols, weights=vals * dot(v)[rows], minlength=size)
        norm = np.linalg.norm(u)
        if norm == 0:
            break
        v = u / norm
    rate = 1.0 / (0.5 * max(np.linalg.norm(dot(v)) ** 2, 1e-9) / n + 1.0 + l2)

    def loss_grad(w, gaps):
        theta = gaps[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps[1:]))])
        s = dot(w)
        upper = np.where(grades < levels - 1, theta[np.minimum(grades, levels - 2)], np.inf)
        lower = np.where(grades > 0, theta[np.maximum(grades - 1, 0)], -np.inf)
        pu, pl = _sigmoid(upper - s), _sigmoid(lower - s)
        p = np.maximum(pu - pl, 1e-12)
        du, dl = pu * (1 - pu), pl * (1 - pl)
        ds = (du - dl) / p / n                       # derivative of -log p by the score
        gw = np.bincount(cols, weights=vals * ds[rows], minlength=size) + l2 * w
        gt = np.zeros(levels - 1)
        np.add.at(gt, np.minimum(grades, levels - 2), np.where(grades < levels - 1, -du / p / n, 0))
        np.add.at(gt, np.maximum(grades - 1, 0), np.where(grades > 0, dl / p / n, 0))
        tail = np.cumsum(gt[::-1])[::-1]             # a gap moves all later thresholds
        return gw, np.concatenate([[tail[0]], tail[1:] * np.exp(gaps[1:])])

    yw, yg, t = w, gaps, 1.0
    for _ in range(steps):
        gw, gg = loss_grad(yw, yg)
        w2 = yw - rate * gw
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - rate * l1, 0)
        g2 = yg - rate * gg
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = (t - 1) / t2
        if ((yw - w2) @ (w2 - w)) > 0:               # going back: start the momentum anew
            momentum, t2 = 0.0, 1.0
        yw, yg = w2 + momentum * (w2 - w), g2 + momentum * (g2 - gaps)
        w, gaps, t = w2, g2, t2
    theta = gaps[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps[1:]))])
    return w, theta


def telling(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Which features tell toxic texts from clean ones, by the likelihood ratio
    of the numbers of texts that have them."""
    both = toxic + clean
    expected = np.maximum(both * n_toxic / max(n_toxic + n_clean, 1), 1e-9)
    rest = np.maximum(both - expected, 1e-9)
    ratio = 2 * (toxic * np.log(np.maximum(toxic, 1e-9) / expected) + clean * np.log(np.maximum(clean, 1e-9) / rest))
    return (toxic > expected) & (ratio > RATIO)


def train_on(indptr: np.ndarray, cols: np.ndarray, counts: np.ndarray, names: list[str], toxic: np.ndarray) -> OrdinalModel:
    """The two fits, on feature counts of texts (CSR form) and their 0/1 labels."""
    nothing = OrdinalModel([], np.zeros(0), np.full(GRADES - 1, 30.0))
    n, pos = len(toxic), int(toxic.sum())
    if not pos or pos == n or not names:
        return nothing
    rows = np.repeat(np.arange(n), np.diff(indptr))

    def only(keep: np.ndarray):
        place = np.cumsum(keep) - 1
        at = keep[cols]
        ptr = np.concatenate([[0], np.cumsum(np.bincount(rows[at], minlength=n))])
        return ptr, place[cols[at]], np.log1p(counts[at].astype(np.float64)), [w for w, k in zip(names, keep) if k]

    ptr, c, v, chosen = only(np.ones(len(names), dtype=bool))
    w, _ = fit(ptr, c, v, len(chosen), toxic, 2, l1=L1, steps=1500)
    found = {f for f, x in zip(chosen, w) if x > 0}
    keep = np.array([x in found for x in names])
    if not keep.any():
        return nothing
    ptr, c, v, chosen = only(keep)
    marks = np.bincount(np.repeat(np.arange(n), np.diff(ptr)), weights=np.expm1(v), minlength=n)
    cuts = np.quantile(marks[toxic == 1], [1 / 3, 2 / 3])
    grades = np.where(toxic == 1, 1 + (marks[:, None] > cuts[None, :]).sum(axis=1), 0)
    w, theta = fit(ptr, c, v, len(chosen), grades, GRADES, l2=L2, steps=3000)
    return OrdinalModel(chosen, w, theta)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, text: str = "text", key: str = "doc_id",
          label: str = "toxic") -> OrdinalModel:
    """Fit on at most ``rows`` labelled documents: the labelled keys of least hash,
    each with one of its texts (that of least hash, if several rows have the key)."""
    known = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k"))
             .agg(F.max(F.col(label).cast("int")).alias("y")).orderBy(F.xxhash64("k"), "k").limit(rows))
    sample = cut_lineage(docs.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
                         .join(F.broadcast(known), "k").withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.xxhash64("t"))))
                         .where("r = 1").drop("r"))

    def standing(wanted):
        """Numbers of texts that have a feature, summed up per task."""
        def run(batches):
            split, n = Features(wanted), {}
            for _, texts in text_blocks(batches, "t"):
                for t in texts:
                    for f in split.count(t):
                        n[f] = n.get(f, 0) + 1
                if len(n) > Features.MOST:
                    yield _counts(n)
                    n = {}
            yield _counts(n)
        return run

    # First the features of toxic texts, then how many clean texts have them:
    # only those that tell the two apart go on to the fit.
    of = {}
    for y in (1, 0):
        part = sample.where("y > 0" if y else "y <= 0").select("t").mapInArrow(standing(of or None), "feature string, n bigint")
        part = part.groupBy("feature").agg(F.sum("n").alias("n"))
        if y:
            of = {f: [n, 0] for f, n in part.where(F.col("n") >= MIN_TEXTS).collect()}
        elif of:
            for f, n in part.collect():
                of[f][1] = n
    size = dict(sample.groupBy((F.col("y") > 0).cast("int").alias("y")).count().collect())
    names = sorted(of)
    if names:
        told = telling(*np.array([of[f] for f in names], dtype=np.float64).T, size.get(1, 0), size.get(0, 0))
        names = [f for f, ok in zip(names, told) if ok]
    place = {w: i for i, w in enumerate(names)}

    def counted(batches):
        split = Features(place)
        for batch, texts in text_blocks(batches, "t"):
            got = [{place[f]: n for f, n in split.count(t).items()} for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("y"), pa.array([np.fromiter(g, np.int32, len(g)).tobytes() for g in got], pa.binary()),
                 pa.array([np.fromiter(g.values(), np.int32, len(g)).tobytes() for g in got], pa.binary())], names=["k", "y", "cols", "counts"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    got = sample.select("k", "y", "t").mapInArrow(counted, f"k {kind}, y int, cols binary, counts binary").toArrow()
    if not got.num_rows:
        return train_on(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), [], np.zeros(0, np.int64))
    got = got.take(pc.sort_indices(got, [("k", "ascending")]))
    lists = [np.frombuffer(b, np.int32) for b in got["cols"].to_pylist()]
    indptr = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    counts = np.frombuffer(b"".join(got["counts"].to_pylist()), np.int32)
    return train_on(indptr, np.concatenate(lists).astype(np.int64), counts, names, (np.array(got["y"].to_pylist()) > 0).astype(np.int64))


def _counts(n: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["feature", "n"])


class Features(dict):
    """Features of words, remembered: the word and its first 4, 5 and 6 letters;
    with ``wanted`` only those."""

    #: Words to remember.
    MOST = 500_000

    def __init__(self, wanted=None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple:
        found = (word, *(word[:n] + "~" for n in (4, 5, 6) if len(word) > n))
        if self.wanted is not None:
            found = tuple(f for f in found if f in self.wanted)
        if len(self) > self.MOST:
            self.clear()
        self[word] = found
        return found

    def count(self, text: str) -> dict[str, int]:
        out: dict[str, int] = {}
        for found in filter(None, map(self.__getitem__, _WORD.findall(text.lower()))):
            for f in found:
                out[f] = out.get(f, 0) + 1
        return out


def severity(docs: DataFrame, model: OrdinalModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(key, severity, p_toxic, grade)`` of every document: the expected
    grade, the chance of any grade above 0, and the likeliest grade."""
    def run(batches):
        linear = model.scorer()
        for batch, texts in text_blocks(batches, "t"):
            above = model.score(linear(texts))
            edge = np.ones((len(texts), 1))
            chances = -np.diff(np.concatenate([edge, above, 0 * edge], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(chances.argmax(axis=1), pa.int32())],
                names=[key, "severity", "p_toxic", "grade"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.selectExpr(f"`{key}` as k", f"cast(`{text}` as string) as t").mapInArrow(
        run, f"`{key}` {kind}, severity double, p_toxic double, grade int")


def reject(docs: DataFrame, model: OrdinalModel, chance: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` without those whose chance of any toxic grade is ``chance`` or
    more; all columns stay as they are, and the texts are not shuffled."""
    names, (t,) = docs.columns, free_names(docs, "__t")
    bare = docs.withColumn(t, F.col(text).cast("string"))

    def run(batches):
        linear = model.scorer()
        for batch, texts in text_blocks(batches, t):
            keep = model.score(linear(texts))[:, 0] < chance
            yield batch.filter(pa.array(keep)).select(names)

    return bare.mapInArrow(run, docs.schema)
