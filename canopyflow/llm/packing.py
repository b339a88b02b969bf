"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm, on islands with elite migration.

The pieces are dealt by hash into shards of a bounded number of pieces. On a shard, islands evolve populations of packings apart: a
packing is a list of bins; crossover injects whole well-filled bins of one parent into the other, takes out the bins that repeat a document,
and puts the displaced documents back best-fit. After each epoch the elites of an island go to the next. The best packing of a shard
counts. A shard stops as soon as it needs no more bins than its tokens fill, the least possible. The last, worst-filled bins of
all shards are dealt into fewer shards and packed once more, until one shard remains or nothing is gained.

Defined results: a null or empty text is one token, the end mark; documents that repeat are packed each; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from random import Random

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopyflow.llm._common import Scratch

CAPACITY, SHARD, ISLANDS, EPOCHS, GENERATIONS, POPULATION, ELITES = 2048, 16_384, 3, 2, 4, 4, 2
#: Chunks, and words, whose ids a task remembers in each of two ages, see Remembered; a batch of texts may pass it.
REMEMBERED = 200_000
#: The pattern for which a chunk of Latin letters and signs needs no search, and such a chunk; its signs are those of one byte, but the one that added tokens begin with.
LETTERS_OR_SIGNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
HEAD_AND_TAIL = "^(?P<head>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)(?P<tail>[!-/:;=>?@\\[-`{-~]*)$"
#: Bytes of text that a worker splits at a time, and of a chunk that it remembers.
TOGETHER, CHUNK = 1 << 21, 64
#: By tokenizer file, the encoder that this worker keeps from task to task, without what it remembered.
_ENCODERS: dict[str, Encoder] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself where it prints, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


class Remembered:
    """What a function gave by name, in two ages: the elder goes when the younger is full, and what is asked for again moves to the younger.

    Both are columns of Arrow, which need a fraction of a dict's memory, and are asked for many names at once.
    """

    def __init__(self, find, longest: int):
        self.find, self.longest = find, longest
        self.forget()

    def __len__(self) -> int:
        return len(self.younger)

    def __getitem__(self, names):
        """The column of what a column of distinct names without blanks gives."""
        import pyarrow as pa
        import pyarrow.compute as pc

        known, ids = (pa.concat_arrays([self.younger.column(k), self.elder.column(k)]) for k in (0, 1))
        at = pc.index_in(names, value_set=known)
        new = names.filter(at.is_null())
        if len(new):
            # as one string, names come over to Python much faster than each alone
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(new)], pa.int32()), new), " ")[0].as_py()
            ids = pa.concat_arrays([ids, pa.array(map(self.find, joined.split(" ")), pa.binary())])
        at, missed = at.fill_null(0).to_numpy(), np.asarray(at.is_null())
        at = np.where(missed, len(known) + np.cumsum(missed) - 1, at)
        found = ids.take(pa.array(at))
        moved = (at >= len(self.younger)) & (pc.binary_length(names).to_numpy() <= self.longest)
        self.younger = pa.RecordBatch.from_arrays([pa.concat_arrays([x, y.filter(pa.array(moved))]) for x, y in zip(self.younger.columns, (names, found), strict=True)], ["name", "ids"])
        return found

    def age(self, most: int) -> None:
        if len(self) > most:
            self.elder, self.younger = self.younger, self.younger.slice(0, 0)

    def forget(self) -> None:
        import pyarrow as pa

        self.younger = self.elder = pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.binary())], ["name", "ids"])


class Encoder:
    """Token ids, as little-endian unsigned 32-bit numbers, of the blank-separated chunks of texts.

    The tokenizer drops blanks and never joins across them, so a chunk's ids are its own, and are remembered. Where the file names the steps
    composing, one blank for many, lower case, splitting by a pattern and bytes as letters, a new chunk of Latin letters, on which the first two
    do nothing, is split here, and its words go through the merges, those of letters with signs behind them only if not met yet; any other chunk
    goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tok, self.chunks, self.words = Tokenizer.from_file(path), Remembered(self.chunk, CHUNK), Remembered(self.word, CHUNK)
        self.merge = self.tok.model.tokenize
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps, cuts = (spec.get("normalizer") or {}).get("normalizers", []), (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        plain = [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
        plain = plain and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and "Regex" in cuts[0]["pattern"] and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
        plain = plain and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
        self.split = regex.compile(cuts[0]["pattern"]["Regex"]).findall if plain else None
        first = {x["content"][:1] for x in spec.get("added_tokens", [])}
        begins = "".join(regex.escape(x) for x in sorted(first))
        # whether the pattern has a run of letters as one word and any signs behind it as another, and no added token begins with one of them
        self.bare = plain and cuts[0]["pattern"]["Regex"] == LETTERS_OR_SIGNS and first <= {"<"}
        self.latin = regex.compile(f"[\x21-\x7e\xa1-\u012f\u0131-\u024f--[{begins}\u0130]]+", regex.V1).fullmatch
        self.letters = _byte_letters()

    def word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.merge(shown)]).tobytes()

    def chunk(self, chunk: str) -> bytes:
        if len(chunk.encode()) > CHUNK or not self.latin(chunk):
            return np.array(self.tok.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.word, self.split(chunk.lower())))

    def distinct(self, chunks):
        """The ids of a column of distinct chunks. Of letters with or without signs behind them, each of both is a word; Arrow cuts them apart."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self.bare:
            return self.chunks[chunks]
        parts = pc.extract_regex(chunks, HEAD_AND_TAIL)
        plain = np.asarray(parts.is_valid())
        words, n = parts.filter(pa.array(plain)).flatten(), int(plain.sum())
        words = pa.concat_arrays([pc.utf8_lower(words[0]), words[1]]).dictionary_encode()
        ids = self.words[words.dictionary].take(words.indices)
        ids = pa.concat_arrays([pc.binary_join_element_wise(ids[:n], ids[n:], b""), self.chunks[chunks.filter(pa.array(~plain))]])
        return ids.take(pa.array(np.where(plain, np.cumsum(plain), n + np.cumsum(~plain)) - 1))

    def encode(self, texts) -> list[bytes]:
        """The ids of each text, of a list or a column of Arrow; where the tokenizer isn't known to drop blanks, of the text as a whole.

        Each chunk that the texts hold is looked up once, however often they hold it, and its ids are put in all its places by Arrow.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if self.split is None:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        cut = pc.ascii_split_whitespace(texts)
        held = cut.flatten().dictionary_encode()
        ids = self.distinct(held.dictionary.cast(pa.string())).take(held.indices)
        self.chunks.age(REMEMBERED)
        self.words.age(REMEMBERED)
        ends = cut.offsets.to_numpy()
        at, data = np.frombuffer(ids.buffers()[1], np.int32)[ends - ends[0]].tolist(), memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(at, at[1:])]

    def forget(self) -> None:
        """A worker outlives its task, and later stages' memory would have to hold what this one remembered."""
        self.chunks.forget()
        self.words.forget()


def _cut(text: bytes, most: int):
    """Parts of a text, cut before blanks, of about so many bytes."""
    at = 0
    while len(text) - at > most and (blank := re.compile(rb"[\x20\x09-\x0D]").search(text, at + most)):
        yield text[at : blank.start()]
        at = blank.start()
    yield text[at:]


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids). The tokenizer's file has to be on every worker."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def work(batches):
        import os

        import pyarrow as pa
        import pyarrow.compute as pc

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from canopyflow.llm import packing as here  # the worker's own module, which outlives a task

        coder = here._ENCODERS.get(path) or here._ENCODERS.setdefault(path, here.Encoder(path))
        last = np.array([end], "<u4").tobytes()
        names = [x.partition(" ")[0] for x in schema.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

        def emit(ids, texts):
            out = []
            for doc, got in zip(ids, texts, strict=True):
                got = np.frombuffer(got + last, "<u4")
                for k, s in enumerate(range(0, len(got), capacity)):
                    x = got[s : s + capacity]
                    out.append((doc, k, s, len(x), zlib.crc32(x.tobytes()), *([x.tolist()] if with_ids else [])))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False)] if out else [pa.array([], k) for k in kinds[: len(names)]], names=names)

        try:
            for batch in batches:
                ids, texts = batch.column("doc_id"), pc.fill_null(batch.column("text").cast(pa.string()), "")
                lengths = pc.binary_length(texts).to_numpy().astype(np.int64)
                ends, a = np.cumsum(lengths), 0
                while a < len(texts):
                    # as many texts as fit together, or one alone
                    b = max(a + 1, int(np.searchsorted(ends, ends[a] - lengths[a] + TOGETHER, "right")))
                    if lengths[a] > TOGETHER and coder.split:
                        got = [b"".join(coder.encode([part])[0] for part in _cut(texts[a].as_py().encode(), TOGETHER))]
                    else:
                        got = coder.encode(texts[a:b])
                    yield emit(ids[a:b].to_pylist(), got)
                    a = b
        finally:
            coder.forget()
            pa.default_memory_pool().release_unused()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema)


def best_fit(bins: list[list[int]], items: list[int], sizes: list[int], capacity: int) -> None:
    """Put items, largest first, each into the fullest bin that holds it."""
    room: dict[int, list[int]] = {}
    mask = 0
    for b, held in enumerate(bins):
        r = capacity - sum(sizes[i] for i in held)
        room.setdefault(r, []).append(b)
        mask |= 1 << r
    for i in sorted(items, key=lambda i: (-sizes[i], i)):
        s = sizes[i]
        if fits := mask >> s:
            r = s + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
            bins[b].append(i)
        else:
            r, b = capacity, len(bins)
            bins.append([i])
        room.setdefault(r - s, []).append(b)
        mask |= 1 << (r - s)


def fitness(bins: list[list[int]], sizes: list[int]) -> tuple[int, int]:
    """Fewer bins first; of as many, the more unevenly filled."""
    return -len(bins), sum(sum(sizes[i] for i in b) ** 2 for b in bins)


def crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, rng: Random) -> list[list[int]]:
    """a with some of the well-filled bins of b."""
    well = [x for x in b if sum(sizes[i] for i in x) * 50 >= 49 * capacity] or b
    gift = [list(x) for x in rng.sample(well, max(1, len(well) // rng.choice((2, 3, 5))))]
    given = {i for x in gift for i in x}
    kept, loose = gift, []
    for x in a:
        if given.isdisjoint(x):
            kept.append(list(x))
        else:
            loose += [i for i in x if i not in given]
    # the emptiest bins are dissolved too, so that their documents can fill others
    kept.sort(key=lambda x: -sum(sizes[i] for i in x))
    for _ in range(min(len(kept) - 1, 1 + len(kept) // 50)):
        loose += kept.pop()
    best_fit(kept, loose, sizes, capacity)
    return kept


def evolve(sizes: list[int], elites: list[list[list[int]]], seed: int, capacity: int, generations: int = GENERATIONS, population: int = POPULATION) -> list[list[list[int]]]:
    """The best packings, best first, after some generations from the elites given."""
    rng, least = Random(seed), -(-sum(sizes) // capacity)
    pool = [*elites]
    while len(pool) < population:
        bins: list[list[int]] = []
        order = list(range(len(sizes)))
        if pool:  # beyond the first, begin from some documents in random order
            rng.shuffle(order)
            head = order[: len(order) // rng.choice((2, 4, 8))]
            fill = 0
            for i in head:
                if not bins or fill + sizes[i] > capacity:
                    bins.append([])
                    fill = 0
                bins[-1].append(i)
                fill += sizes[i]
            order = order[len(head) :]
        best_fit(bins, order, sizes, capacity)
        pool.append(bins)
        if len(bins) <= least:
            break
    pool.sort(key=lambda x: fitness(x, sizes), reverse=True)
    for _ in range(generations):
        if len(pool[0]) <= least:
            break
        a, b = rng.sample(pool[: max(2, population)], 2)
        pool = sorted([*pool, crossover(a, b, sizes, capacity, rng), crossover(b, a, sizes, capacity, rng)], key=lambda x: fitness(x, sizes), reverse=True)[:population]
    return pool


def _number(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _bins(numbers) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(numbers):
        out.setdefault(int(k), []).append(i)
    return list(out.values())


STATE = "shard long, island int, pids array<long>, sizes array<int>, elites array<array<int>>"


def pack_shards(items: DataFrame, shards: int, scratch: Scratch, name: str, capacity: int) -> DataFrame:
    """(pid, length, shard, bin, load) for items (pid, length) dealt into so many shards."""
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("pid", F.lit(name)), F.lit(shards)).cast("long"))
    whole = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("pid", F.col("length").cast("int").alias("length")))).alias("x"))
    state = whole.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), F.col("x.pid").alias("pids"), F.col("x.length").alias("sizes"), F.array().cast("array<array<int>>").alias("elites"))
    state = state.repartition(max(1, min(shards * ISLANDS, 1024)), "shard", "island")

    def epoch(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                sizes = [int(x) for x in r.sizes]
                pool = evolve(sizes, [_bins(e) for e in r.elites], zlib.crc32(f"{r.shard} {r.island} {len(r.elites)}".encode()), capacity)
                rows.append((r.shard, r.island, r.pids, r.sizes, [_number(b, len(sizes)) for b in pool[:ELITES]]))
            yield pd.DataFrame(rows, columns=["shard", "island", "pids", "sizes", "elites"])

    for k in range(EPOCHS):
        state = scratch.save(state.mapInPandas(epoch, STATE), f"{name}-epoch{k}")
        if k < EPOCHS - 1:
            arrive = state.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("elites").alias("new"))
            state = state.join(arrive, ["shard", "island"]).select("shard", "island", "pids", "sizes", F.concat("elites", "new").alias("elites"))

    def best(batches):
        import pandas as pd

        for pdf in batches:
            parts = []
            for r in pdf.itertuples(index=False):
                bins = np.array(r.best, np.int64)
                parts.append(pd.DataFrame({"pid": np.array(r.pids, np.int64), "length": np.array(r.sizes, np.int64), "shard": r.shard, "bin": bins, "load": np.bincount(bins, np.array(r.sizes))[bins].astype(np.int64)}))
            if parts:
                yield pd.concat(parts)

    count = F.array_max(F.element_at("elites", 1))
    top = state.groupBy("shard").agg(F.min_by("island", F.struct(count, "island")).alias("island"))
    won = state.join(top, ["shard", "island"]).select("shard", "pids", "sizes", F.element_at("elites", 1).alias("best"))
    return scratch.save(won.mapInPandas(best, "pid long, length long, shard long, bin long, load long"), f"{name}-packed")


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """pieces (any columns, with length from 1 to capacity) with sequence_id and offset: the sequences' parts lie gapless from 0."""
    spark = pieces.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.save(pieces.withColumn("pid", F.monotonically_increasing_id()), "pieces")
    todo, done = pieces.where(F.col("length") < capacity).select("pid", "length"), []
    count, k = todo.count(), 0
    while count:
        shards = max(1, -(-count // shard))
        packed = pack_shards(todo, shards, scratch, f"round{k}", capacity)
        # of every shard, the bins under 97 % go into the next round, unless this was the last
        final = shards == 1 or k >= 4
        full = packed if final else packed.where(F.col("load") * 100 >= capacity * 97)
        done.append(full.select("pid", "length", F.concat_ws("-", F.lit(k), "shard", "bin").alias("name")))
        if final:
            break
        todo, k = scratch.save(packed.where(F.col("load") * 100 < capacity * 97).select("pid", "length"), f"left{k}"), k + 1
        count = todo.count()
    offset = F.sum("length").over(Window.partitionBy("name").orderBy("pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    own = pieces.where(F.col("length") >= capacity).select("pid", (-F.col("pid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for d in done:
        part = F.split("name", "-")
        number = part[0].cast("long") * (1 << 58) + part[1].cast("long") * (1 << 20) + part[2].cast("long")
        own = own.unionByName(d.select("pid", "length", "name", number.alias("sequence_id")).select("pid", "sequence_id", offset.alias("offset")))
    return pieces.join(own, "pid").drop("pid")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, path or tokenizer_path(), capacity), capacity)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
