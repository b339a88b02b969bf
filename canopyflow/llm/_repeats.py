"""Hashing of consecutive symbols with numpy, shared by the operators that look for repeated passages.

A window of W symbols is represented by its anchor: the k consecutive symbols in it whose hash is least (the first of equals).
The anchor depends on the window's content alone, so equal windows have equal anchors at equal places, and a window whose anchor
occurs once in the corpus occurs once itself. Consecutive windows with one anchor form a run; a run's context is all they cover.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
#: Symbols worked on at once; what is longer goes in pieces that overlap by a window.
PIECE = 1 << 20
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads each bit of a 64-bit number over the others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE + 4096)
        made = []
        for b in (_BASE, _INVERSE):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def prefix(sym: np.ndarray) -> np.ndarray:
    power, _ = powers(len(sym) + 1)
    out = np.zeros(len(sym) + 1, np.uint64)
    np.cumsum(sym * power[: len(sym)], out=out[1:])
    return out


def hashes(p: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    """Hash of symbols start..end-1, from their prefix sums."""
    _, inverse = powers(len(p))
    return mix((p[end] - p[start]) * inverse[: len(p)][start])


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of texts that lie one after another, and where each text's words begin among them."""
    out, begins = [], []
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    s = 0
    while s < len(data):
        e = min(len(data), s + PIECE)
        while e < len(data):  # to the next blank
            found = np.flatnonzero(SPACE[data[e : e + 4096]])
            if len(found):
                e += int(found[0])
                break
            e = min(len(data), e + 4096)
        x = data[s:e]
        word = ~SPACE[x]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | edge[s + 1 : e]
        last[:-1] &= ~word[1:] | edge[s + 1 : e]
        a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
        p = prefix(BYTE[x])
        out.append(hashes(p, a, b) + (b - a).astype(np.uint64))
        begins.append(a + s)
        s = e
    got = np.concatenate(out) if out else np.zeros(0, np.uint64)
    at = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    return mix(got), np.searchsorted(at, bounds)


def runs(sym: np.ndarray, bounds: np.ndarray, k: int, window: int):
    """For each run of windows with one anchor: document number, first window's start, windows, anchor hash and context hash; piece by piece."""
    total, width = len(sym), window - k + 1
    for s in range(0, total, PIECE):
        x = sym[s : s + PIECE + window - 1]
        m = len(x) - window + 1
        if m <= 0:
            break
        p = prefix(x)
        gram = hashes(p, slice(None, -k), slice(k, None))
        cur = (gram & _HIGH) | np.arange(len(gram), dtype=np.uint64)
        have = 1
        while have * 2 <= width:
            cur = np.minimum(cur[:-have], cur[have:])
            have *= 2
        if have < width:
            cur = np.minimum(cur[: have - width], cur[width - have :])
        at = (cur & _LOW).astype(np.int64)
        inside = bounds - s
        cuts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, inside, inside - window + 1])
        lo = np.unique(cuts[(cuts >= 0) & (cuts < m)])
        n = np.diff(np.append(lo, m))
        doc = np.searchsorted(bounds, lo + s, "right") - 1
        ok = bounds[doc + 1] - s - lo >= window
        lo, n, doc = lo[ok], n[ok], doc[ok]
        anchor = at[lo]
        context = hashes(p, lo, lo + n - 1 + window)
        context = mix(context + (anchor - lo).astype(np.uint64) * _BASE + n.astype(np.uint64) * _INVERSE)
        yield doc, lo + s - bounds[doc], n, gram[anchor].view(np.int64), context.view(np.int64)


def at_places(sym: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hashes of so many symbols from each of the given places of one text on; the places ascend."""
    out = np.empty(len(starts), np.int64)
    i = 0
    while i < len(starts):
        s = int(starts[i])
        j = int(np.searchsorted(starts, s + PIECE, "left"))
        p, at = prefix(sym[s : int(starts[j - 1]) + length]), starts[i:j] - s
        out[i:j] = hashes(p, at, at + length).view(np.int64)
        i = j
    return out


def offsets(first: int, length: int) -> list[int]:
    """How far on the other rank of each doubling lies, from strings of the first length to those of the length asked for."""
    out, have = [], first
    while have < length:
        out.append(min(have, length - have))
        have += out[-1]
    return out


def marked(n: int, starts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Which of n symbols lie in a window of the runs given."""
    out = np.zeros(n + 1, np.int32)
    np.add.at(out, starts, 1)
    np.add.at(out, np.minimum(starts + counts - 1 + window, n), -1)
    return np.cumsum(out[:-1]) > 0


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column of an Arrow batch (null: none), and where each text begins in them."""
    import pyarrow as pa

    column = column.fill_null("").cast(pa.large_binary())
    _, where, data = column.buffers()
    at = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)), at - at[0]


RUNS = "doc long, sub int, lo int, n int, h long, c long"
#: A place in a text: its row's number among those that share the id, times 2^32, plus the symbols before it.
POSITIONS = "doc long, at long, key long"
#: Joins of positions go through their keys in so many parts, one after another, so that only a part's shuffle lies on the disks.
PARTS = 2


def pieces(batch):
    """An Arrow batch in slices of about PIECE bytes of text, so that the arrays of one slice stay small; a longer text is a slice of its own."""
    import pyarrow.compute as pc

    size = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // PIECE)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(size)], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def all_runs(docs, by_word: bool, k: int, window: int):
    """RUNS of every text of keyed documents."""
    import pyarrow as pa

    def work(batches):
        for batch in (x for whole in batches for x in pieces(whole)):
            data, at = flat(batch.column("text"))
            sym, bounds = words(data, at) if by_word else (BYTE[data], at)
            docs_, subs = (batch.column(i).to_numpy() for i in range(2))
            for d, lo, n, h, c in runs(sym, bounds, k, window):
                yield pa.RecordBatch.from_arrays([pa.array(docs_[d]), pa.array(subs[d]), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(h), pa.array(c)], names=["doc", "sub", "lo", "n", "h", "c"])

    return docs.select("doc", "sub", "text").mapInArrow(work, RUNS)


def positions(docs, wanted, by_word: bool, first: int, length: int):
    """POSITIONS: the starts of the windows wanted and the places at which the doublings look up another rank, each with the hash of its
    first symbols; places with fewer symbols left in their text are none."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    reach = {0}
    for o in offsets(first, length):
        reach |= {x + o for x in reach}

    def work(batches):
        for batch in (x for whole in batches for x in pieces(whole)):
            data, at = flat(batch.column("text"))
            sym, bounds = words(data, at) if by_word else (BYTE[data], at)
            for i, (d, s) in enumerate(zip(batch.column("doc").to_numpy(), batch.column("sub").to_numpy(), strict=True)):
                lo, n = (np.array(batch.column(c)[i].as_py(), np.int64) for c in ("lo", "n"))
                x = sym[bounds[i] : bounds[i + 1]]
                turn = np.zeros(len(x) + 1, np.int32)
                for o in reach:
                    np.add.at(turn, lo + o, 1)
                    np.add.at(turn, lo + n + o, -1)
                p = np.flatnonzero(np.cumsum(turn)[:-1] > 0)
                key = at_places(x, p, first)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), d)), pa.array(p + (int(s) << 32)), pa.array(key)], names=["doc", "at", "key"])

    lists = wanted.groupBy("doc", "sub").agg(F.collect_list("lo").alias("lo"), F.collect_list("n").alias("n"))
    return docs.join(lists, ["doc", "sub"]).select("doc", "sub", "text", "lo", "n").mapInArrow(work, POSITIONS)


def doubled(docs, wanted, by_word: bool, first: int, length: int, scratch):
    """(doc, sub, lo, n = 1): the windows wanted that also start earlier, by prefix doubling.

    A position's first rank is the number that its first symbols hash to; positions whose rank is unique are dropped. Then a position's key is
    the pair of its rank and the rank found, by a join, at the position one offset further; Spark sorts the pairs that several positions
    hold and numbers them in that order, which gives the next ranks, and the offset doubles until the length is reached.
    Places that are looked up only can't do harm: what stands equal and earlier there is equal and earlier.
    """
    from functools import reduce

    from pyspark.sql import functions as F

    def by_parts(name, old, by, make):
        """The tables that make(part's condition) gives, one after another; what it was made of goes."""
        done = []
        for i in range(PARTS):
            done.append(scratch.save(make(F.pmod(F.xxhash64(*by), F.lit(PARTS)) == i, i), f"{name}-{i}"))
            scratch.drop(f"{name}-held-{i}")
        scratch.drop(*old)
        return reduce(lambda x, y: x.unionByName(y), done), [f"{name}-{i}" for i in range(PARTS)]

    def held(rows, keys, *aggs):
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times"), *aggs).where("times > 1").drop("times")

    place, steps = F.struct("doc", "at"), offsets(first, length)
    keyed0 = scratch.save(positions(docs, wanted, by_word, first, length), "keyed0")
    scratch.drop()

    def several(mine, i):
        rows = keyed0.where(mine)
        return rows.join(scratch.save(held(rows, ["key"]), f"ranked0-held-{i}").hint("shuffle_hash"), "key", "left_semi").select("doc", "at", F.col("key").alias("rank"))

    ranked, made = by_parts("ranked0", ["keyed0"], ["key"], several)
    for k, o in enumerate(steps, 1):

        def paired(mine, i, ranked=ranked, o=o):
            further = ranked.select("doc", (F.col("at") - o).alias("at"), F.col("rank").alias("further"))
            return ranked.where(mine).join(further.where(mine).hint("shuffle_hash"), ["doc", "at"])

        now, made = by_parts(f"keyed{k}", made, ["doc"], paired)
        if k < len(steps):
            order = scratch.save(held(now, ["rank", "further"]), f"held{k}")
            order = scratch.save(order.orderBy("rank", "further").select("*", F.monotonically_increasing_id().alias("next")), f"order{k}")
            ranked = scratch.save(now.join(order, ["rank", "further"]).select("doc", "at", F.col("next").alias("rank")), f"ranked{k}")
            scratch.drop(*made, f"held{k}", f"order{k}")
            made = [f"ranked{k}"]
    keys = ["rank", "further"] if steps else ["rank"]
    last = now if steps else ranked
    firsts = scratch.save(held(last, keys, F.min(place).alias("first")), "firsts")
    scratch.drop()
    again = last.join(firsts.hint("shuffle_hash"), keys).where(place != F.col("first"))
    return again.select("doc", F.shiftright("at", 32).cast("int").alias("sub"), F.col("at").bitwiseAND(2**32 - 1).cast("int").alias("lo"), F.lit(1).alias("n"))


def repeated_runs(docs, by_word: bool, k: int, window: int, scratch):
    """(later, rest): runs whose whole context starts earlier in the corpus, so that each of their windows does; and the first runs of
    their context whose anchor also stands in another context, of which single windows may start earlier."""
    from pyspark.sql import functions as F

    every = scratch.save(all_runs(docs, by_word, k, window), "runs")
    twice = every.groupBy("h").count().where("count > 1").select("h")
    kept = scratch.save(every.join(twice.hint("shuffle_hash"), "h", "left_semi").select(*every.columns), "kept")
    scratch.drop("runs")
    first = scratch.save(kept.groupBy("h", "c").agg(F.min(F.struct("doc", "sub", "lo")).alias("first")), "first")
    scratch.drop()
    several = first.groupBy("h").count().where("count > 1").select("h", F.lit(True).alias("more"))
    first = first.join(several, "h", "left")
    # what is neither later nor, as its anchor has one context only, in question goes here
    marked_ = kept.join(first.hint("shuffle_hash"), ["h", "c"]).select("doc", "sub", "lo", "n", (F.struct("doc", "sub", "lo") != F.col("first")).alias("later"), "more").where("later or more")
    marked_ = scratch.save(marked_.drop("more"), "marked")
    scratch.drop("kept", "first")
    return marked_.where("later").drop("later"), marked_.where("not later").drop("later")


def with_spans(docs, spans):
    """Keyed documents beside the lists lo and n of their spans; null where there are none."""
    from pyspark.sql import functions as F

    lists = spans.groupBy("doc", "sub").agg(F.collect_list("lo").alias("lo"), F.collect_list("n").alias("n"))
    return docs.join(lists, ["doc", "sub"], "left").select("doc", "text", "lo", "n")
