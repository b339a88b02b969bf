"""Substring dedup by level-wise doubling of word windows.

Levels take windows of 5, 10 and 20 words (a quarter, a half and the whole of the length asked for). Only windows that several places
hold at one level are extended to twice the length, by joining each with the repeated window that follows it, until no candidate is left
to extend: beyond the length asked for none is needed, as longer repeats are covered by windows of it (see _repeats.doubled).
Before the levels two filters take what needs none: a window whose anchor (see _repeats) stands once in the corpus is unique, and contexts
that repeat whole leave by their hash.

Defined results: a null or empty text has no words and loses none; a text with fewer words than a window loses none; rows that share a
doc_id are documents of their own, in order of text; a null doc_id comes before all others; very long texts are worked on in overlapping
pieces; an empty table gives an empty result; other columns of the input are ignored.
Windows are compared by 64 bits of hash, whole contexts by 128.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyflow.llm._common import NULL_ID, Scratch, keyed
from canopyflow.llm._repeats import PARTS, doubled, marked, repeated_runs, with_spans


def repeated_spans(docs: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """(doc, sub, lo, n): n windows from word lo on that start earlier in keyed documents."""
    later, rest = repeated_runs(docs, True, max(window // 2, 1), window, scratch)
    return later.unionByName(doubled(docs, rest, True, max(window // 4, 1), window, scratch))


def substring_dedup(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_text (the kept words joined by one space).

    A word goes if a window of that many words that covers it also starts earlier: in a smaller doc_id, or before in the same document.
    """
    spark = docs.sparkSession
    base, scratch = keyed(docs, id_col, text_col), Scratch(spark, "substring")
    joined = with_spans(base, scratch.save(repeated_spans(base, window, scratch), "spans"))
    scratch.drop("marked", "firsts", *(f"keyed2-{i}" for i in range(PARTS)))

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text, lo, n in zip(batch.column("text").fill_null("").cast(pa.large_binary()), batch.column("lo"), batch.column("n"), strict=True):
                words = text.as_py().split()
                total = len(words)
                if lo.is_valid:
                    gone = marked(total, np.array(lo.as_py(), np.int64), np.array(n.as_py(), np.int64), window)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                rows.append((total, total - len(words), b" ".join(words).decode()))
            total, gone, kept = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc", "n_words", "n_removed", "kept_text"])

    out = joined.mapInArrow(cut, "doc long, n_words long, n_removed long, kept_text string")
    return out.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept_text")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH w AS (SELECT doc_id, generate_subscripts(ws, 1) AS p, unnest(ws) AS word
           FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents)),
win AS (SELECT *, string_agg(word, ' ') OVER ahead AS words, count(*) OVER ahead AS n
        FROM w WINDOW ahead AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
late AS (SELECT doc_id, p, word, n = 20 AND row_number() OVER (PARTITION BY words, n ORDER BY doc_id, p) > 1 AS again FROM win),
cut AS (SELECT doc_id, p, word, max(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM late),
doc AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM cut GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN doc USING (doc_id)
"""


def brute_force(rows: list[tuple[int, str | None]], window: int = 20) -> list[tuple]:
    """The same by a dictionary of every window, for tests: rows are (doc_id, text), ids distinct."""
    import re

    seen, out = {}, {}
    texts = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    for d in sorted(texts):
        words, gone = texts[d], set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.setdefault(key, d)
        out[d] = (d, len(words), len(gone), hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())
    return [out[d] for d in sorted(out)]
