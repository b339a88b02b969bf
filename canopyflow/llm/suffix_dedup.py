"""Suffix-array dedup by distributed prefix doubling.

Positions are ranked by their first 50 bytes, then by their first 100, by pairs of the rank at the position and the rank one offset further,
looked up by a join on the position; positions whose rank is unique are dropped before the offset doubles, and doubling ends at the
length asked for (see _repeats.doubled). As a suffix array of every byte would need many times the
input, the doubling runs on what two filters before it leave: an anchor (see _repeats) that stands once in the corpus drops every string it
stands for, and contexts that repeat whole leave by their hash. The first rank is a hash of the bytes, so equal prefixes have equal
ranks, but their order isn't that of an alphabet, which nothing here depends on; pairs of the last length are grouped, not numbered.

Defined results: a null or empty text has no bytes and loses none, as does a text shorter than the length; rows that share a doc_id are
documents of their own, in order of text; a null doc_id comes before all others; very long texts are worked on in overlapping pieces; an
empty table gives an empty result; other columns of the input are ignored. Prefixes are compared by 64 bits of hash, whole contexts by 128.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyflow.llm._common import NULL_ID, Scratch, keyed
from canopyflow.llm._repeats import PARTS, doubled, marked, repeated_runs, with_spans


def repeated_spans(docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(doc, sub, lo, n): n strings from byte lo on that start earlier in keyed documents."""
    first = (length + 1) // 2
    later, rest = repeated_runs(docs, False, first, length, scratch)
    return later.unionByName(doubled(docs, rest, False, first, length, scratch))


def suffix_dedup(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, spans (array of [start, end) byte pairs removed), kept (the remaining bytes).

    A byte goes if a string of that many bytes that covers it also starts earlier: in a smaller doc_id, or before in the same document.
    """
    spark = docs.sparkSession
    base, scratch = keyed(docs, id_col, text_col), Scratch(spark, "suffix")
    joined = with_spans(base, scratch.save(repeated_spans(base, length, scratch), "spans"))
    scratch.drop("marked", "firsts", *(f"keyed1-{i}" for i in range(PARTS)))

    def cut(batches):
        import pyarrow as pa

        pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            total, gone, spans, kept = [], [], [], []
            for text, lo, n in zip(batch.column("text").fill_null("").cast(pa.large_binary()), batch.column("lo"), batch.column("n"), strict=True):
                raw, cuts = text.as_py(), []
                size = len(raw)
                if lo.is_valid:
                    out = marked(size, np.array(lo.as_py(), np.int64), np.array(n.as_py(), np.int64), length)
                    raw = np.frombuffer(raw, np.uint8)[~out].tobytes()
                    turn = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
                    cuts = [{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()]
                total.append(size)
                gone.append(size - len(raw))
                spans.append(cuts)
                kept.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pair), pa.array(kept, pa.binary())], names=["doc", "n_bytes", "n_removed", "spans", "kept"])

    out = joined.mapInArrow(cut, "doc long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary")
    return out.select(F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "spans", "kept")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH raw AS (SELECT doc_id, encode(coalesce(text, '')) AS bytes FROM documents),
place AS (SELECT doc_id, bytes, unnest(range(1, octet_length(bytes) + 1)) AS p FROM raw),
str AS (SELECT doc_id, p, bytes[p:p] AS byte, CASE WHEN p + 99 <= octet_length(bytes) THEN bytes[p:p + 99] END AS s FROM place),
late AS (SELECT doc_id, p, byte, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 AS again FROM str),
cut AS (SELECT doc_id, p, byte, max(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM late),
edge AS (SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS begins FROM cut),
doc AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
               string_agg(hex(byte), '' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM edge GROUP BY doc_id)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM documents LEFT JOIN doc USING (doc_id)
"""


def brute_force(rows: list[tuple[int, str | None]], length: int = 100) -> list[tuple]:
    """The same by a dictionary of every string, for tests: rows are (doc_id, text), ids distinct."""
    seen, out = set(), []
    for d, t in sorted(rows):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(raw[i : i + length])
        n = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
        out.append((d, len(raw), int(gone.sum()), n, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return out
