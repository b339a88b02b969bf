"""Cross-tokenizer alignment: which ids of two tokenizers cover the same bytes, how often over a corpus, and how well each text keeps to that.

A text (with a space before it) is encoded by both; where tokens of both end, it is cut into groups, and all pairs of occurrences inside a
group are links. Texts are cut at single blanks between two other characters first: neither tokenizer joins across one, so each word is
encoded and aligned once in a task and kept in a bounded table, and whatever its length a text needs no more memory than its words.

The corpus part is a cogroup of postings: each text's pairs of ids with their multiplicity are dealt by the ids, sorted, and meet the
number of texts that hold the pair and the mark of their A id's highest such number; what each posting contributes is summed by text. A pair
that very many texts hold is dealt in slices by text, as a common word's pair may be in all of them.

Defined results: null, empty and unfaithful texts (the bytes of the tokens of a side aren't the text's) have zeros and ''; rows that share
a doc_id are texts of their own; equal texts count as several; ties for the highest count are all best; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from itertools import accumulate, chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopyflow.llm._common import Scratch

#: Words with their alignment that a task keeps at most.
KEPT_WORDS = 300_000
#: Bytes of text that are aligned together.
BLOCK_BYTES = 1 << 20
#: A pair with more than this share of all postings is dealt in slices; so no more than SLICES pairs are, and their list is broadcast.
SLICES = 4096
#: Ids of the second tokenizer lie below this, so a pair of ids is one number (the ids of both files fit 31 bits that way).
SIDE_B = 32_768
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Inside a word both tokenizers also part a letter from a mark after it, and a lone line feed from a letter after it; the second's vocabulary is asked.
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_ATOM = re.compile(rf"(?<={_LETTER})(?=[.,;:!?])|(?<=\S\n)(?={_LETTER})")
_JOINED = re.compile(rf"{_LETTER}[.,;:!?]|\n{_LETTER}")
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and a bounded table of words already aligned."""

    def __init__(self, path_a: str, path_b: str, keep: int = KEPT_WORDS):
        import json

        from public_tokenizers import PATTERN
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letter = _byte_letters()
        ranks = {bytes(letter[c] for c in w): i for w, i in vocabulary.items() if all(c in letter for c in w)}
        self.b, self.keep = SentencePieceProcessor(model_file=path_b), keep
        # numbered in order of its merges, so its ids are ranks; special tokens are left out, so their strings are plain text
        self.a = Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = {i: w for w, i in ranks.items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        if len(pieces) > SIDE_B or max(self.bytes_a) >= 1 << 16:
            raise ValueError("a vocabulary is too large for pairs in one number")
        self.long_a, self.long_b = np.zeros(max(self.bytes_a) + 1, np.int64), np.array([len(p) for p in self.bytes_b])
        for i, w in self.bytes_a.items():
            self.long_a[i] = len(w)
        self.parted = not any(map(_JOINED.search, pieces))
        self.forget()

    def forget(self) -> None:
        # atoms of each word met; atoms that begin a word, and others
        self.known: dict[str, tuple[int, ...]] = {}
        self.first: dict[str, int] = {}
        self.inner: dict[str, int] = {}
        # per atom: its groups as text (None: unfaithful), A tokens, B tokens, groups, links, and where its pairs begin
        self.groups: list[str | None] = []
        self.stats, self.begin, self.pairs, self.times = array("q"), array("q", [0]), array("i"), array("i")

    def learn(self, words: list[str]) -> None:
        cut = [_ATOM.split(w) if self.parted else [w] for w in words]
        first, inner = list({a[0] for a in cut} - self.first.keys()), list({x for a in cut for x in a[1:]} - self.inner.keys())
        # both put a blank before all that they encode, so an atom inside a word stands behind what they surely part from it
        items = [(self.first, a, a, 0) for a in first] + [(self.inner, a, x + a, 1 + len(x)) for a, x in ((a, "x\n" if a[0].isalpha() else "x") for a in inner)]
        # white space at an end of a text would run together with the blank beside it
        loose = lambda w: not w or w[0].isspace() or w[-1].isspace()
        solid, single = [i for i in items if not loose(i[2])], [i for i in items if loose(i[2])]
        for n, (where, atom, _, _) in enumerate(solid + single, len(self.groups)):
            where[atom] = n
        for some in (solid, *([i] for i in single)):
            self.add([w for _, _, w, _ in some], [k for _, _, _, k in some])
        for w, a in zip(words, cut, strict=True):
            self.known[w] = (self.first[a[0]], *[self.inner[x] for x in a[1:]])

    def add(self, words: list[str], skip: list[int]) -> None:
        """Align words, without their first skip bytes (a blank is put before each); all are encoded as one text, as neither side joins across single blanks."""
        if not words:
            return
        joined = " ".join(words)
        ids_a, ids_b = self.a.encode_ordinary(" " + joined), self.b.encode(joined)
        want = (" " + joined).encode()
        if b"".join([self.bytes_a[i] for i in ids_a]) != want or b"".join([self.bytes_b[i] for i in ids_b]) != want:
            if len(words) > 1:  # which of them?
                half = len(words) // 2
                self.add(words[:half], skip[:half])
                self.add(words[half:], skip[half:])
            else:
                self.groups.append(None)
                self.stats.extend((0, 0, 0, 0))
                self.begin.append(len(self.pairs))
            return
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        end_a, end_b = np.cumsum(self.long_a[a]), np.cumsum(self.long_b[b])
        end = np.intersect1d(end_a, end_b, assume_unique=True)
        word_end = np.cumsum([len(w.encode()) + 1 for w in words])
        owner = np.searchsorted(word_end, end)
        kept = end > (np.concatenate([[0], word_end[:-1]]) + np.array(skip))[owner]
        group_a, group_b = np.searchsorted(end, end_a), np.searchsorted(end, end_b)
        n_a, n_b = np.bincount(group_a, minlength=len(end)), np.bincount(group_b, minlength=len(end))
        sums = [np.bincount(owner[kept], x[kept], len(words)).astype(np.int64) for x in (n_a, n_b, np.ones(len(end), np.int64), n_a * n_b)]
        # all pairs of occurrences of small groups at once; of large ones by different ids
        first_b = np.cumsum(n_b) - n_b
        small = kept & (n_a * n_b <= 256)
        some = np.flatnonzero(small[group_a])
        times = n_b[group_a[some]]
        which = np.repeat(first_b[group_a[some]] - np.cumsum(times) + times, times) + np.arange(times.sum())
        key = np.repeat(owner[group_a[some]], times) << 31 | np.repeat(a[some], times) * SIDE_B + b[which]
        count = np.ones(len(key), np.int64)
        first_a = np.cumsum(n_a) - n_a
        for g in np.flatnonzero(kept & ~small).tolist():
            (x, nx), (y, ny) = (np.unique(ids[f : f + n], return_counts=True) for ids, f, n in ((a, first_a[g], n_a[g]), (b, first_b[g], n_b[g])))
            key = np.concatenate([key, (owner[g] << 31 | x[:, None] * SIDE_B + y[None, :]).ravel()])
            count = np.concatenate([count, (nx[:, None] * ny[None, :]).ravel()])
        key, where = np.unique(key, return_inverse=True)
        self.pairs.frombytes((key & ((1 << 31) - 1)).astype(np.int32).tobytes())
        self.times.frombytes(np.bincount(where, count, len(key)).astype(np.int32).tobytes())
        at = self.begin[-1]
        self.begin.frombytes((at + np.searchsorted(key, np.arange(1, len(words) + 1) << 31)).tobytes())
        self.stats.frombytes(np.stack(sums, 1).tobytes())
        # groups as text
        single = (n_a == 1) & (n_b == 1)
        said = [f"{ids_a[i]}|{ids_b[j]}" if s else f"{','.join(map(str, ids_a[i : i + n]))}|{','.join(map(str, ids_b[j : j + m]))}" for s, i, j, n, m in zip(single.tolist(), first_a.tolist(), first_b.tolist(), n_a.tolist(), n_b.tolist(), strict=True)]
        upto = np.searchsorted(owner, np.arange(len(words)), "right").tolist()
        start = (np.searchsorted(owner, np.arange(len(words))) + np.bincount(owner, ~kept, len(words)).astype(np.int64)).tolist()
        self.groups += [";".join(said[i:j]) for i, j in zip(start, upto, strict=True)]

    def parts(self, text: str) -> list[str]:
        """A text cut at single blanks between other characters."""
        parts = text.split(" ")
        # a part that is empty or begins or ends with white space may not stand alone
        return _CUT.split(text) if any(not p or p[0].isspace() or p[-1].isspace() for p in parts) else parts

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, groups and links of each text, groups as text, where each text's pairs begin, pairs, times); words not met before are encoded together."""
        cut = [self.parts(t) if t else [] for t in texts]
        if len(self.known) > self.keep:
            self.forget()
        known = self.known
        if new := {p for parts in cut for p in parts if p not in known}:
            self.learn(list(new))
        words = [[w for p in parts for w in known[p]] for parts in cut]
        strings = [[self.groups[w] for w in ids] for ids in words]
        words, strings = ([[] if None in s else w for w, s in zip(words, strings, strict=True)], ["" if None in s else ";".join(s) for s in strings])
        flat = np.fromiter(chain.from_iterable(words), np.int64)
        end = np.cumsum([0, *map(len, words)])
        stats, begin = np.array(self.stats).reshape(-1, 4), np.array(self.begin)
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(stats[flat].reshape(-1, 4), axis=0)])[end]
        # all pairs of all words, summed by text and pair
        size = (begin[1:] - begin[:-1])[flat]
        at = np.repeat(begin[flat] - np.cumsum(size) + size, size) + np.arange(size.sum())
        owner = np.repeat(np.repeat(np.arange(len(texts)), np.diff(end)), size)
        key, where = np.unique(owner << 31 | np.array(self.pairs, np.int64)[at], return_inverse=True)
        times = np.bincount(where, np.array(self.times)[at], len(key)).astype(np.int32)
        return np.diff(sums, axis=0), strings, np.searchsorted(key, np.arange(len(texts) + 1) << 31), (key & ((1 << 31) - 1)).astype(np.int32), times


#: The aligner of a worker process, kept from task to task.
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _decoded(raw: bytes | None) -> str | None:
    try:
        return None if raw is None else raw.decode()
    except UnicodeDecodeError:  # such bytes come back from neither side
        return None


def postings(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs array<int>, times array<int>), a row for each row of docs."""
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"

    def work(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if (path_a, path_b) not in _ALIGNERS:
            _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
        both = _ALIGNERS[path_a, path_b]
        names = [f.split()[0] for f in schema.split(", ")]

        def emit(ids, texts):
            stats, groups, begin, pairs, times = both.align([_decoded(t) for t in texts])
            sha = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            lists = [pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(x)) for x in (pairs, times)]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c) for c in stats.T.astype(np.int64)), pa.array(sha, pa.string()), *lists], names=names)

        for batch in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(i)
                texts.append(t.as_py())
                size += len(texts[-1] or b"")
                if size > BLOCK_BYTES:
                    yield emit(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield emit(ids, texts)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(work, schema)


def pair_counts(each: DataFrame) -> DataFrame:
    """(pair, texts, best): how many texts hold a pair, summed map-side, and whether no pair of its A id is in more."""
    counts = each.groupBy("pair").agg(F.count(F.lit(1)).alias("texts")).withColumn("side", F.floor(F.col("pair") / SIDE_B))
    top = counts.groupBy("side").agg(F.max("texts").alias("most"))
    return counts.join(top, "side").select("pair", "texts", (F.col("texts") == F.col("most")).alias("best"))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import public_tokenizers

    scratch = Scratch(docs.sparkSession, "alignment")
    found = postings(docs, path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model"), id_col, text_col)
    # numbered as they are written, so that rows that share a doc_id stay apart
    found = scratch.save(found.withColumn("row", F.monotonically_increasing_id()), "postings")
    each = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    counts = scratch.save(pair_counts(each), "counts")
    total = counts.agg(F.sum("texts")).first()[0] or 0
    # less than SLICES pairs, of 12 bytes each
    slices = counts.where(F.col("texts") * SLICES > total).select("pair", F.ceil(F.col("texts") * SLICES / max(total, 1)).cast("int").alias("slices"))
    dealt = each.join(F.broadcast(slices), "pair", "left").select("pair", F.coalesce(F.pmod(F.xxhash64("row"), F.col("slices")).cast("int"), F.lit(0)).alias("slice"), "row", "times")
    marks = counts.join(F.broadcast(slices), "pair", "left").select("pair", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)).alias("slice"), "texts", "best")
    met = dealt.hint("merge").join(marks, ["pair", "slice"])
    gives = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0).cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("texts")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return found.join(gives, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
