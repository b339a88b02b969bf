"""Recall of the candidate searches on crowded data."""

import numpy as np
import pytest

from canopyflow.llm import chosen_path, projection_dedup


@pytest.mark.parametrize("topics", [1, 2])
def test_projection_dedup_with_background_cosine(spark, topics):
    # unrelated vectors of a topic have cosine 0.7; two topics lie opposite each other, so that their mean is none
    rng = np.random.default_rng(7)
    m = np.zeros(64)
    m[0] = 1.0

    def unit(x):
        x[..., 0] = 0
        return x / np.linalg.norm(x, axis=-1)[..., None]

    u = unit(rng.standard_normal((6_000, 64)))
    u[:300] = unit(u[300:600] * 0.72 + unit(rng.standard_normal((300, 64))) * np.sqrt(1 - 0.72**2))
    x = (np.sqrt(0.7) * m + np.sqrt(0.3) * u) * np.where(np.arange(6_000) % topics, -1, 1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    assert near.sum() > 400
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in projection_dedup.near_dedup(df).collect()}
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.99 * near.sum()


def test_jaccard_join_inside_a_frequent_passage(spark, monkeypatch):
    # 300 texts hold one passage, between words of their own; pairs at 0.8 lie mostly inside it. Small nodes stand in for a large table.
    for name, value in (("LEAF_PAIRS", 2048), ("LEAF_SETS", 64)):
        monkeypatch.setattr(chosen_path, name, value)
    rng = np.random.default_rng(5)

    def fresh(n):
        return [f"w{x}" for x in rng.integers(0, 10**9, n)]

    passage, texts = fresh(154), {}
    for i in range(300):
        texts[i] = passage + fresh(int(rng.integers(130, 180)))
    for i in range(100):
        both = passage + fresh(10)
        texts[10_000 + i], texts[20_000 + i] = both + fresh(16), both + fresh(16)
    grams = lambda w: {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
    for i in range(100):
        a, b = grams(texts[10_000 + i]), grams(texts[20_000 + i])
        assert 0.8 <= len(a & b) / len(a | b) < 0.86
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in chosen_path.jaccard_join(df, recall=0.97).collect()}
    assert sum(got[20_000 + i].class_id != 20_000 + i for i in range(100)) >= 97


def test_met_counts_the_depth():
    assert chosen_path.met(0.8, 4, 14) > 0.999 > chosen_path.met(0.8, 16, 14)
    assert all(chosen_path.met(0.8, d, 14) > chosen_path.met(0.8, d + 1, 14) for d in range(1, 12))
