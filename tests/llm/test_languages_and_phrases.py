"""Collocations against counts in plain Python; the recurrent network against numeric gradients and held-out texts."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from canopyflow.llm import collocations, language_id


def brute(rows, least, max_n, top):
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, max_n + 1):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i : i + k])] += 1
    cand = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= least}
    out = {}
    for (lang, w), a in cand.items():
        if any(lang == other and len(x) > len(w) and f >= a and any(x[i : i + len(w)] == w for i in range(len(x))) for (other, x), f in cand.items()):
            continue
        score, k = min((1000 * a * n[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, some in out.items() for i, (s, a, p, left, right) in enumerate(sorted(some)[:top], 1))


def phrases(df):
    return sorted(tuple(r) for r in df.collect())


def test_collocations_equal_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    words = ["ab", "AB", "cd", "é", "É", "f", "ab-cd", "\x00", "ß", "x", "y", "z"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", "!", " ", " ", " "]
    rows = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))) for _ in range(120)]
    rows += [("en", None), (None, None), ("en", ""), ("fr", "one word"), ("en", "new york city " * 3_000), ("en", "x" * 100_000)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4).withColumn("phrase", F.lit(1)).withColumn("f", F.lit(2))
    for least, max_n, top in ((4, 5, 2000), (2, 3, 5), (6, 2, 2000)):
        got = collocations.collocations(docs, least, max_n, top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert phrases(got) == brute(rows, least, max_n, top) != []
    # a full bit table lets everything through and changes nothing
    monkeypatch.setattr(collocations, "MOST_BITS", 1 << 15)
    monkeypatch.setattr(collocations.Sieve, "passes", lambda self, h: np.ones(len(h), bool))
    assert phrases(collocations.collocations(docs, 4)) == brute(rows, 4, 5, 2000)
    assert phrases(collocations.collocations(docs.limit(0))) == []


def test_sieve_holds_all_that_was_put_in(spark):
    h = np.random.default_rng(3).integers(-(2**63), 2**63, 5_000)
    table = collocations.Sieve(collocations.sieve(spark.createDataFrame([(int(x),) for x in h], "h long"), len(h)))
    assert table.passes(h.view(np.uint64)).all() and all(int(x) in table for x in h.view(np.uint64)[:50])
    other = np.random.default_rng(4).integers(0, 2**63, 20_000).view(np.uint64)
    assert table.passes(other).mean() < 0.02


def test_gradients_equal_differences():
    net = language_id.Network.new(["a", "b", "c"], units=4)
    for layer in (net.forward, net.backward):
        layer.inputs, layer.hidden = layer.inputs.astype(float), layer.hidden.astype(float)
    net.out_f, net.out_b, net.bias = (x.astype(float) for x in (net.out_f, net.out_b, net.bias))
    x, length = language_id.padded([b"abc", b" de fg", b"z", b"hello12"])
    lang = np.array([0, 1, 2, 1])
    _, grads = net.gradients(x, length, lang)
    for w, g in zip(net.weights, grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        w[at] += 1e-4
        up = net.gradients(x, length, lang)[0]
        w[at] -= 2e-4
        down = net.gradients(x, length, lang)[0]
        w[at] += 1e-4
        assert abs(g[at] - (up - down) / 2e-4) < 1e-3


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    net = language_id.train(docs, steps=200)
    got = language_id.identify(docs, net).join(docs.select("doc_id", "lang"), "doc_id").where(language_id.fold() == 2)
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 20 and right / n > 0.95
    # the languages of held-out documents and their ids play no part
    other = docs.withColumn("lang", F.when(language_id.fold() == 2, "xx").otherwise(F.col("lang")))
    again = language_id.train(other, steps=3)
    assert again.langs == net.langs
    awkward = spark.createDataFrame([(1, None), (None, "12 .,;"), (2, ""), (3, "x" * 300_000), (3, "Die Katze"), (4, "\x00\x85é"), (5, "日本語 " * 50), (6, " \n ")], "doc_id long, text string").withColumn("score", F.lit(9)).withColumn("word", F.lit("w"))
    rows = [tuple(r) for r in language_id.identify(awkward, net).collect()]
    assert [r[1] for r in rows if r[0] in (1, 2, 6, None)] == ["und"] * 4 and all(r[1] in net.langs and 0 <= r[2] <= 1 for r in rows if r[0] in (3, 4, 5)) and len(rows) == 8
    broken = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("cast(X'61FF62' as string)").alias("text"))
    assert language_id.identify(broken, net).first().lang_pred in net.langs
    # without anything to learn from
    for none in (docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        assert language_id.train(none) is None
    assert language_id.identify(awkward, None).select("lang_pred", "score").distinct().collect() == [("und", 0.0)]
    assert len(net and language_id.Reader(net).positions("Die Katze".encode())) == 9
