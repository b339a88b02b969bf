"""Phrase collocation mining: phrases of two to five words that stand together more often than their parts would.

All 1..max_n-grams that can be frequent become rows of a DataFrame, counted by language and phrase; prefix and suffix counts are joined to every
cut of a candidate, scored in exact decimals; candidates that a one-word extension accounts for go by an anti-join; a window ranks the rest.
A phrase is frequent only if every two and every three of its neighbouring words are, so rare pairs and triples are kept out of the rows: they are
first counted by hash, and what reaches the floor goes into a bit table of bounded size that is sent to the tasks. Hash collisions and that table only let more through,
as the phrases themselves are counted afterwards; no count, whether of words or of phrases, is estimated.

A chain of one-word extensions reaches every longer phrase (each link of it is at least as frequent as the longest), so one word is enough.

Defined results: null and empty texts have no words; a null language is `und`; rows that repeat are counted each; equal scores go by count,
then phrase in order of UTF-8 bytes; a language without candidates, and so an empty table, has no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopyflow.llm._common import Scratch

LEAST, MAX_N, TOP, WHOLE = 100, 5, 2000, 100
#: Bits of a table of hashes at the most (32 MB); bits for each entry below that.
MOST_BITS, BITS_EACH = 1 << 28, 24
#: Words and hashes that a task sums up before it hands them on.
HELD_WORDS, HELD_PAIRS = 200_000, 2_000_000
#: Occurrences of phrases in one batch of rows.
OUT_ROWS = 100_000
#: Where in a hash its three places in a bit table begin.
SHIFTS = (0, 18, 36)
_UPPER, _ENDS = bytes(range(65, 91)), b".,;:!?\n\x0b\x0c\r"
#: ASCII letters in lower case, tabs as blanks, ends of pieces as line feeds.
_PLAIN = bytes.maketrans(_UPPER + b"\t" + _ENDS, _UPPER.lower() + b" " + b"\n" * len(_ENDS))
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def word_hash(word: bytes, lang: str) -> int:
    """64 bits, never 0, as 0 stands for the end of a piece and for words that can't be in a phrase."""
    import xxhash

    return xxhash.xxh64_intdigest(word, seed=xxhash.xxh64_intdigest(lang.encode())) or 1


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * _M1) ^ b
    x = (x ^ (x >> np.uint64(30))) * _M2
    return x ^ (x >> np.uint64(27))


class Sieve:
    """A bit table of hashes (three bits each): tells surely what isn't in it."""

    def __init__(self, table: bytes):
        self.bytes, self.table, self.mask = table, np.frombuffer(table, np.uint8), np.uint64(len(table) * 8 - 1)

    def __contains__(self, h: int) -> bool:
        bits, mask = self.bytes, len(self.bytes) * 8 - 1
        return all(bits[(x := h >> s & mask) >> 3] >> (x & 7) & 1 for s in SHIFTS)

    def passes(self, h: np.ndarray) -> np.ndarray:
        hit = np.ones(len(h), bool)
        for s in SHIFTS:
            x = (h >> np.uint64(s)) & self.mask
            hit &= (self.table[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return hit


def sieve(hashes: DataFrame, n: int) -> bytes:
    """The bit table of a column h of n hashes, of MOST_BITS at the most; Spark joins the bits, the driver the parts of 4 KB."""
    bits = min(MOST_BITS, 1 << max(15, math.ceil(math.log2(BITS_EACH * max(n, 1)))))
    slot = F.explode(F.array(*(F.shiftrightunsigned("h", s).bitwiseAND(bits - 1) for s in SHIFTS))).alias("slot")
    parts = hashes.select(slot).groupBy(F.shiftright("slot", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(32_767)).alias("bits"))
    out = bytearray(bits // 8)
    for r in parts.toLocalIterator():
        out[r.part * 4096 : r.part * 4096 + 4096] = r.bits
    return bytes(out)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null")


def _batch(rows, names):
    import pyarrow as pa

    kinds = {"lang": pa.string(), "phrase": pa.binary(), "words": pa.int32(), "h": pa.int64(), "f": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for n, c in zip(names, rows, strict=True)], names=names)


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase binary, f): every word with its count; the empty phrase counts all words of a language."""

    def work(batches):
        held: dict[str, Counter] = {}

        def hand_on():
            for lang, counts in held.items():
                yield _batch(([lang] * len(counts), list(counts), list(counts.values())), ["lang", "phrase", "f"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().translate(_PLAIN).split()
                counts = held.setdefault(lang, Counter())
                counts.update(words)
                counts[b""] += len(words)
                if len(counts) > HELD_WORDS:
                    yield from hand_on()
        yield from hand_on()

    return texts.mapInArrow(work, "lang string, phrase binary, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


class Words:
    """Numbers for the words that a sieve lets through, within one language; 0 for others and for the ends of pieces."""

    def __init__(self, lang: str, table: Sieve):
        self.lang, self.table = lang, table
        self.number: dict[bytes, int] = {}
        self.words, self.hashes = [b""], [0]

    def of(self, text: bytes) -> list[int]:
        out, number = [], self.number
        for piece in text.translate(_PLAIN).split(b"\n"):
            if words := piece.split():
                try:
                    out += [number[w] for w in words]
                except KeyError:
                    for w in words:
                        if w not in number:
                            h = word_hash(w, self.lang)
                            number[w] = len(self.words) if h in self.table else 0
                            if number[w]:
                                self.words.append(w)
                                self.hashes.append(h)
                    out += [number[w] for w in words]
                out.append(0)
        return out


def _numbered(batches, table: bytes, size: int = 1 << 21):
    """(words of a language, their numbers in texts of some MB) for all rows of a task."""
    seen, held, sieve_ = {}, {}, Sieve(table)

    def hand_on():
        for lang, ids in held.items():
            yield seen[lang], np.array(ids, np.int64)
            if len(seen[lang].number) > HELD_WORDS:
                del seen[lang]
        held.clear()

    got = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_py()
            held.setdefault(lang, []).extend(seen.setdefault(lang, Words(lang, sieve_)).of(raw))
            got += len(raw)
            if got > size:
                yield from hand_on()
                got = 0
    yield from hand_on()


def _chains(known: Words, ids: np.ndarray, sieves: list[Sieve]):
    """From n = 2 on, one beyond the sieves: (hashes of the n-grams that begin at each word, which of them can be frequent)."""
    x = np.array(known.hashes, np.uint64)[ids]
    h, may = x, x != 0
    for n in range(2, len(sieves) + 3):
        h, may = pair_hash(h[:-1], x[n - 1 :]), may[:-1] & may[1:]
        if n - 2 < len(sieves):
            may = may.copy()
            may[may] = sieves[n - 2].passes(h[may])
        yield h, may


def chain_hash_counts(texts: DataFrame, words, tables: list) -> DataFrame:
    """(h, f): chains of len(tables) + 2 words by hash, where all shorter chains in them can be frequent; f is at least the count of any chain with that hash."""

    def work(batches):
        sieves, parts, n = [Sieve(t.value) for t in tables], [], 0

        def summed():
            h, f = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            key, at = np.unique(h, return_inverse=True)
            return key, np.bincount(at, f, len(key)).astype(np.int64)

        for known, ids in _numbered(batches, words.value):
            *_, (h, may) = _chains(known, ids, sieves)
            parts.append(np.unique(h[may], return_counts=True))
            n += len(parts[-1][0])
            if n > HELD_PAIRS:
                parts = [summed()]
                n = len(parts[0][0])
                if n > HELD_PAIRS // 2:
                    yield _batch((parts[0][0].view(np.int64), parts[0][1]), ["h", "f"])
                    parts, n = [], 0
        if parts:
            key, f = summed()
            yield _batch((key.view(np.int64), f), ["h", "f"])

    return texts.mapInArrow(work, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


def phrase_counts(texts: DataFrame, words, tables: list, max_n: int) -> DataFrame:
    """(lang, phrase binary, words, f): phrases of 2 to max_n words whose chains pass the tables, a row for each occurrence, counted exactly by Spark."""

    def work(batches):
        import pyarrow as pa

        sieves = [Sieve(t.value) for t in tables]
        for known, ids in _numbered(batches, words.value):
            may = [m for (_, m), _ in zip(_chains(known, ids, sieves), sieves)]
            # at: where a phrase of n words can begin; code: a number for its first n - 1 words, equal for equal words
            at = np.flatnonzero(may[0])
            code = ids[at]
            for n in range(2, max_n + 1):
                last = may[min(n - 2, len(may) - 1)]
                # the chain that ends the phrase; those before it have been seen to
                ends = at + max(n - 2 - (len(may) - 1), 0)
                ok = ends < len(last)
                ok[ok] = last[ends[ok]]
                at, code = at[ok], code[ok]
                if not len(at):
                    break
                _, first, code = np.unique(code << 32 | ids[at + n - 1], return_index=True, return_inverse=True)
                phrases = pa.array([b" ".join([known.words[w] for w in ids[p : p + n]]) for p in at[first].tolist()], pa.binary())
                for k in range(0, len(code), OUT_ROWS):
                    some = phrases.take(pa.array(code[k : k + OUT_ROWS]))
                    yield pa.RecordBatch.from_arrays([pa.array([known.lang] * len(some), pa.string()), some, pa.array(np.full(len(some), n, np.int32))], names=["lang", "phrase", "words"])

    return texts.mapInArrow(work, "lang string, phrase binary, words int").groupBy("lang", "phrase", "words").agg(F.count(F.lit(1)).alias("f"))


def collocations(docs: DataFrame, least: int = LEAST, max_n: int = MAX_N, top: int = TOP, whole: int = WHOLE, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases.

    least: occurrences that a candidate needs; whole: the share, in hundredths, of a candidate's occurrences inside a longer one at which it goes.
    """
    spark = docs.sparkSession
    scratch, texts, sc = Scratch(spark, "collocations"), _texts(docs, text_col, lang_col), spark.sparkContext
    single = scratch.save(word_counts(texts).where((F.col("f") >= least) | (F.col("phrase") == F.lit(b""))), "words")
    words = single.where(F.col("phrase") != F.lit(b""))

    def hashed(batches):
        for b in batches:
            yield _batch((np.array([word_hash(w, lang) for lang, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], np.uint64).view(np.int64),), ["h"])

    table = sc.broadcast(sieve(words.select("lang", "phrase").mapInArrow(hashed, "h long"), words.count()))
    tables = []
    for n in range(2, min(max_n, 3) + 1):
        frequent = scratch.save(chain_hash_counts(texts, table, tables).where(F.col("f") >= least).select("h"), f"chains{n}")
        tables.append(sc.broadcast(sieve(frequent, frequent.count())))
        scratch.drop(f"chains{n}")
    phrases = phrase_counts(texts, table, tables, max_n).where(F.col("f") >= least)
    counts = scratch.save(words.withColumn("words", F.lit(1)).unionByName(phrases).select("lang", F.col("phrase").cast("string").alias("phrase"), "words", "f"), "counts")
    return ranked(counts, single.where(F.col("phrase") == F.lit(b"")).select("lang", F.col("f").alias("n")), top, whole)


def ranked(counts: DataFrame, totals: DataFrame, top: int, whole: int) -> DataFrame:
    """counts (lang, phrase, words, f) and totals (lang, n) to ranked phrases."""
    rows = counts.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumn("w", F.split("phrase", " "))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("tail"))
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(F.broadcast(totals), "lang")
    # 1000 a n has 38 digits at the most, and a is at most l and r, so the quotient is within 1000 n
    score = F.expr("(1000BD * cast(a as decimal(18, 0)) * cast(n as decimal(16, 0))) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b"))
    # what a one-word extension accounts for
    w = F.split("phrase", " ")
    inner = F.explode(F.array(F.array_join(F.slice(w, F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice(w, F.lit(2), F.col("words") - 1), " "))).alias("phrase")
    wider = rows.where("words > 2").select("lang", F.col("a").alias("wide"), inner).groupBy("lang", "phrase").agg(F.max("wide").alias("wide"))
    kept = best.join(wider, ["lang", "phrase"], "left").where(F.col("wide").isNull() | (100 * F.col("wide") < whole * F.col("b.a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


OP11_SQL = """WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS t FROM documents WHERE text IS NOT NULL),
ws AS (SELECT lang, list_filter(string_split_regex(t, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM piece),
g AS (SELECT lang, i AS words, unnest(list_transform(range(1, len(w) - i + 2), lambda s: array_to_string(list_slice(w, s, s + i - 1), ' '))) AS phrase FROM ws, (SELECT unnest([1, 2, 3, 4, 5]) AS i) k WHERE len(w) >= i),
f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL), n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 100),
cut AS (SELECT c.lang, c.phrase, c.words, c.w, c.a, k, array_to_string(list_slice(w, 1, k), ' ') AS head, array_to_string(list_slice(w, k + 1, words), ' ') AS tail FROM cand c, (SELECT unnest([1, 2, 3, 4]) AS k) ks WHERE k < words),
scored AS (SELECT c.lang, c.phrase, c.words, c.w, c.a, k, h.f AS l, t.f AS r, n.n, (1000::HUGEINT * c.a * n.n // (h.f::HUGEINT * t.f))::BIGINT AS score FROM cut c JOIN f h ON h.lang = c.lang AND h.phrase = c.head JOIN f t ON t.lang = c.lang AND t.phrase = c.tail JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM cand x WHERE x.lang = b.lang AND x.words > b.words AND x.a >= b.a AND contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept QUALIFY rank <= 2000"""
