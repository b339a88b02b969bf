"""Cross-tokenizer alignment against whole texts encoded at once and pairs counted in plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from canopyflow.llm.token_alignment import SIDE_B, Aligner, align

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def tokenizer_a():
    t = Tokenizer.from_file(PATHS[0])
    t.encode_special_tokens = True
    return t


def brute(rows):
    """Whole texts by the files' own libraries."""
    both, a, b = Aligner(*PATHS), tokenizer_a(), SentencePieceProcessor(model_file=PATHS[1])
    found = []
    for doc, text in rows:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            if b"".join(both.bytes_a[i] for i in ids_a) == (" " + text).encode() == b"".join(both.bytes_b[i] for i in ids_b):
                ends = [set(), set()]
                for k, (ids, held) in enumerate(((ids_a, both.bytes_a), (ids_b, both.bytes_b))):
                    at = 0
                    for i in ids:
                        at += len(held[i])
                        ends[k].add(at)
                shared = sorted(ends[0] & ends[1])
                groups = [([], []) for _ in shared]
                for k, (ids, held) in enumerate(((ids_a, both.bytes_a), (ids_b, both.bytes_b))):
                    at = g = 0
                    for i in ids:
                        at += len(held[i])
                        groups[g][k].append(i)
                        g += at == shared[g]
        found.append((doc, groups))
    texts, best = Counter(), defaultdict(int)
    for _, groups in found:
        texts.update({(a, b) for x, y in groups for a in x for b in y})
    for (a, _), n in texts.items():
        best[a] = max(best[a], n)
    out = []
    for doc, groups in found:
        links = [(a, b) for x, y in groups for a in x for b in y]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(texts[p] == best[p[0]] for p in links), sum(texts[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "the", "Heit", "keit", "'s", "é", "日本", "▁", "12", "<|endoftext|>", "<s>", "!!", "́", "\x1f", "\x85", "😀", "\x00", "​", "ﬁ", ". ", "the house "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))) for i in range(600)]
    rows += [(1, None), (None, "the house"), (2, ""), (2, ""), (3, "the house"), (3, "the house"), (4, "a b " * 60_000), (5, "x" * 30_000), (6, " "), (7, "日本語" * 3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("row", F.lit("clash")).withColumn("pairs", F.lit(0))
    got = align(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(got) == brute(rows)


def test_a_pair_in_very_many_texts_is_dealt_in_slices(spark):
    rows = [(i, "the" if i % 3 else "the house of") for i in range(9_000)]
    assert rows_of(align(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_tables_without_tokens(spark):
    assert rows_of(align(spark.createDataFrame([], "doc_id long, text string"))) == []
    assert rows_of(align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    broken = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("cast(X'61FF62' as string)").alias("text"))
    assert rows_of(align(broken)) == [(0, 0, 0, 0, 0, 0, 0, "")]


def test_a_group_of_many_tokens_is_counted_by_id(spark):
    both = Aligner(*PATHS)
    # as if no token but the last of the first side ended where one of the second does
    both.long_a, both.bytes_a, both.a = np.array([1, 2]), {0: b" ", 1: b"xx"}, type("A", (), {"encode_ordinary": lambda self, t: [0, *[1] * 600]})()
    both.long_b, both.bytes_b, both.b = np.array([2, 2, 1]), [b" x", b"xx", b"x"], type("B", (), {"encode": lambda self, t: [0, *[1] * 599, 2]})()
    both.add(["x" * 1200], [0])
    assert list(both.stats) == [601, 601, 1, 601 * 601]
    assert dict(zip(both.pairs, both.times, strict=True)) == {0: 1, 1: 599, 2: 1, SIDE_B: 600, SIDE_B + 1: 600 * 599, SIDE_B + 2: 600}


def test_first_side_equals_its_own_library_on_every_character():
    both, own = Aligner(*PATHS), tokenizer_a()
    texts = [f" a{chr(k)}b {chr(k)}1{chr(k)}{chr(k)}" for k in range(1, 0x3100) if not 0xD800 <= k < 0xE000]
    assert [both.a.encode_ordinary(t) for t in texts] == [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
