"""Counterfactual-regularised toxicity classifier.

A logistic model over the presence of words and word beginnings in a text. It is fitted on a bounded sample of labelled documents; in a
copy of each sentence that names a group, the name is swapped for another group's, and the squared change of score between a
sentence and its copies is added to the loss, so that naming a group moves the score little. Scoring reads whole texts.

Defined results: a null or empty text is scored by the intercept alone; rows that repeat are scored each; a document with several labels is
toxic if one says so; null labels are ignored; without labels of both kinds the score is the share of toxic labels, smoothed; a null doc_id counts as the text ''.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of groups, swapped for one another within a row. (Fixed values.)
IDENTITY_TERMS = (
    ("women", "men", "transgender", "nonbinary"),
    ("woman", "man"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("black", "white", "asian", "hispanic", "latino", "african", "european", "indigenous"),
    ("blind", "deaf", "disabled"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("mexican", "american", "chinese", "indian", "german", "french", "turkish", "polish"),
)
#: Labelled documents that a fit takes at most: the first by hash of their id.
SAMPLE = 12_000
#: Features with the strongest association that the model keeps, of those past this many standard errors.
FEATURES, ERRORS = 4_000, 4.0
_WORD = re.compile(r"[^\W_]+")
_OTHERS = {w: tuple(x for x in row if x != w) for row in IDENTITY_TERMS for w in row}


def features(text: str | None) -> set[str]:
    """Lower-case words, and the first five letters (marked ^) of longer ones."""
    found = set(_WORD.findall((text or "").lower()))
    return found | {"^" + w[:5] for w in found if len(w) > 5}


def swapped(found: set[str], k: int) -> set[str] | None:
    """The features with each group's name replaced by another's, the k-th; None if no group is named."""
    named = [w for w in found if w in _OTHERS]
    if not named:
        return None
    out = found - set(named) - {"^" + w[:5] for w in named if len(w) > 5}
    for w in named:
        new = _OTHERS[w][k % len(_OTHERS[w])]
        out |= {new, "^" + new[:5]} if len(new) > 5 else {new}
    return out


class Model:
    """weights by feature, intercept."""

    def __init__(self, weights: dict[str, float], intercept: float):
        self.weights, self.intercept = weights, intercept

    def score(self, text: str | None) -> float:
        found = set(_WORD.findall((text or "").lower()))
        get = self.weights.get
        # words and beginnings that the model does not hold weigh nothing
        z = self.intercept + sum(get(w, 0.0) for w in sorted(found & self.words)) + sum(get(w, 0.0) for w in sorted({"^" + w[:5] for w in found if len(w) > 5 and w[:5] in self.starts}))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    @property
    def words(self) -> set[str]:
        if not hasattr(self, "_words"):
            self._words = {w for w in self.weights if w[0] != "^"}
            self._starts = {w[1:] for w in self.weights if w[0] == "^"}
        return self._words

    @property
    def starts(self) -> set[str]:
        return self._starts


def fit(rows: list[tuple[str | None, int]], penalty: float = 1.0, swaps: int = 3, steps: int = 300, keep: int = FEATURES) -> Model:
    """penalty: weight of the squared score changes under swaps; 0 gives a plain logistic model."""
    y = np.array([int(v) for _, v in rows], float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model({}, float(np.log(share / (1 - share))))
    # a text is held as the numbers of its features, as the driver has room for few sets of words
    number: dict[str, int] = {}
    sets = [np.array([number.setdefault(w, len(number)) for w in features(t)], np.int32) for t, _ in rows]
    every, label = np.concatenate(sets), np.repeat(y, [len(x) for x in sets])
    a, b = (np.bincount(every[label == k], minlength=len(number)).astype(float) for k in (0, 1))
    n1, n0 = y.sum(), len(y) - y.sum()
    names, often = list(number), np.flatnonzero(a + b >= 3)
    a, b = a[often], b[often]
    gap = np.abs(b / n1 - a / n0) / np.sqrt((a + b) / len(y) * (1 - (a + b) / (len(y) + 1)) * (1 / n1 + 1 / n0))
    best = sorted((i for i in range(len(often)) if gap[i] >= ERRORS), key=lambda i: (-gap[i], names[often[i]]))[:keep]
    groups = [w for w in sorted(_OTHERS) for w in ((w, "^" + w[:5]) if len(w) > 5 else (w,))]
    at = {w: i for i, w in enumerate(dict.fromkeys([*(names[often[i]] for i in best), *groups]))}
    column, kept = np.array([at.get(w, -1) for w in names], np.int64), list(at)
    del number, names, every, label

    def matrix(picked):
        return np.repeat(np.arange(len(picked)), [len(p) for p in picked]), np.array([i for p in picked for i in p], np.int64), len(picked)

    sets = [np.sort(x[x >= 0]) for x in (column[x] for x in sets)]
    row, col, n = matrix(sets)
    # every group's name has a column, so the columns of a text tell which it names
    pairs = [(i, sorted(at[w] for w in other)) for i, x in enumerate(sets) for k in range(swaps) if (other := swapped({kept[j] for j in x}, k)) is not None]
    pair_of = np.array([i for i, _ in pairs], np.int64)
    row2, col2, n2 = matrix([s for _, s in pairs])
    w, c = np.zeros(len(at)), float(np.log(n1 / n0))
    m, v, mc, vc = np.zeros(len(at)), np.zeros(len(at)), 0.0, 0.0
    for t in range(1, steps + 1):  # Adam
        z = np.bincount(row, w[col], n) + c
        s = 1 / (1 + np.exp(-z))
        dz = (s - y) / n
        g2 = np.zeros(len(at))
        if n2:
            z2 = np.bincount(row2, w[col2], n2) + c
            s2 = 1 / (1 + np.exp(-z2))
            change = 2 * penalty * (s2 - s[pair_of]) / n2
            np.subtract.at(dz, pair_of, change * s[pair_of] * (1 - s[pair_of]))
            d2 = change * s2 * (1 - s2)
            g2 = np.bincount(col2, d2[row2], len(at))
            gc2 = d2.sum()
        else:
            gc2 = 0.0
        g = np.bincount(col, dz[row], len(at)) + g2 + 2e-5 * w
        gc = dz.sum() + gc2
        m, v, mc, vc = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mc + 0.1 * gc, 0.999 * vc + 0.001 * gc * gc
        rate = 0.05
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        c -= rate * (mc / (1 - 0.9**t)) / (np.sqrt(vc / (1 - 0.999**t)) + 1e-8)
    return Model({k: float(w[i]) for k, i in at.items() if abs(w[i]) > 1e-3}, float(c))


def fold(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def train(docs: DataFrame, labels: DataFrame, penalty: float = 1.0, sample: int = SAMPLE, text_col: str = "text") -> Model:
    """Fitted on at most `sample` labelled documents whose fold is not 0: the first in order of a hash of doc_id."""
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(fold() != 0)
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def brief(batches):  # only what the fit reads goes to the driver
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([" ".join(sorted(set(_WORD.findall((t.as_py() or "").lower())))) for t in b.column("text")], pa.string()), b.column("toxic")], names=["doc_id", "text", "toxic"])

    picked = docs.select("doc_id", F.col(text_col).cast("string").alias("text")).join(chosen, "doc_id").mapInArrow(brief, "doc_id long, text string, toxic int")
    rows = sorted(tuple(r) for r in picked.select("doc_id", F.coalesce("text", F.lit("")), "toxic").collect())
    return fit([(t, y) for _, t, y in rows], penalty)


def score_documents(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with a column for the score; the model is sent along (at most FEATURES weights and the groups), and a batch's texts become strings one at a time."""
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m = Model(*held.value)
        return pa.array([m.score(t.as_py()) for t in texts], pa.float64())

    return docs.withColumn(name, score(F.col(text_col).cast("string")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
