"""Language ID by a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

The network reads a text word by word (letters with the blank before them, or a run of other bytes, at most SPAN; longer ones are cut): one layer of gated units
reads each word's bytes forwards, another backwards, and a softmax over both labels every position. A text's probabilities are the mean
over the positions of its letters. State starts anew at each word, so equal words have equal labels, and a task labels each word once and
keeps it in a bounded table; a text of words that no other has costs a pass of the network over all its bytes, in the same memory.

Defined results: null texts and texts without a letter are `und` with score 0, as is all if no document has a language to learn from;
rows that repeat are labelled each; null languages teach nothing; equal probabilities go to the language that sorts first; a null doc_id
counts as the text '' for the fold; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents that a fit takes at most (the first by hash of their id), and different words of theirs (the first by hash).
SAMPLE, WORDS = 4_000, 60_000
#: Bytes of a word; gated units of each direction; words that a task keeps at most, and labels together.
SPAN, UNITS, KEPT_WORDS, TOGETHER = 24, 16, 250_000, 4_096
STEPS, BATCH, RATE = 500, 256, 0.02
_WORD = re.compile(rb"\s?[A-Za-z\x80-\xff]{1,%d}|[^A-Za-z\x80-\xff\s]{1,%d}|\s{1,%d}" % (SPAN - 1, SPAN, SPAN))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
#: Bytes that count as letters of a word: ASCII letters and all of other scripts' characters.
_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode(errors="ignore"))


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each word, filled up with 0; lengths)"""
    length = np.array([len(w) for w in words])
    wide = int(length.max(initial=1))
    return np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in words), np.uint8).reshape(len(words), wide).astype(np.int64), length


def backwards(length: np.ndarray, wide: int) -> np.ndarray:
    """Per word and position the position that mirrors it within the word; beyond the word, itself."""
    at = np.arange(wide)[None, :]
    return np.where(at < length[:, None], length[:, None] - 1 - at, at)


@dataclass
class Layer:
    """Gated recurrent units that read in one direction. inputs: a row of 3 x units for each byte, for update, reset and new state."""

    inputs: np.ndarray
    hidden: np.ndarray

    @staticmethod
    def new(units: int, rng: np.random.Generator) -> Layer:
        return Layer(rng.normal(0, 0.3, (256, 3 * units)).astype(np.float32), rng.normal(0, units**-0.5, (units, 3 * units)).astype(np.float32))

    def run(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each byte; keep takes what going back needs."""
        n, wide, units = *x.shape, self.hidden.shape[0]
        h, out = np.zeros((n, units), np.float32), np.empty((n, wide, units), np.float32)
        for t in range(wide):
            gx, gh = self.inputs[x[:, t]], h @ self.hidden
            gates = _sigmoid(gx[:, : 2 * units] + gh[:, : 2 * units])
            z, r, own = gates[:, :units], gates[:, units:], gh[:, 2 * units :]
            new = np.tanh(gx[:, 2 * units :] + r * own)
            if keep is not None:
                keep.append((h, z, r, own, new))
            h = new + z * (h - new)
            out[:, t] = h
        return out

    def back(self, x: np.ndarray, kept: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of inputs and hidden, back through time from those of the states."""
        d_hidden, d_rows, carry = np.zeros_like(self.hidden), [], 0.0
        for t in range(x.shape[1] - 1, -1, -1):
            h, z, r, own, new = kept[t]
            d = d_out[:, t] + carry
            d_new = d * (1 - z) * (1 - new * new)
            d_z, d_r = d * (h - new) * z * (1 - z), d_new * own * r * (1 - r)
            d_gh = np.concatenate([d_z, d_r, d_new * r], 1)
            d_hidden += h.T @ d_gh
            carry = d * z + d_gh @ self.hidden.T
            d_rows.append(np.concatenate([d_z, d_r, d_new], 1))
        flat, rows = x[:, ::-1].T.ravel(), np.concatenate(d_rows)
        order = np.argsort(flat, kind="stable")
        used, first = np.unique(flat[order], return_index=True)
        d_inputs = np.zeros_like(self.inputs)
        d_inputs[used] = np.add.reduceat(rows[order], first, axis=0)
        return d_inputs, d_hidden


@dataclass
class Network:
    langs: list[str]
    forward: Layer
    backward: Layer
    out_f: np.ndarray
    out_b: np.ndarray
    bias: np.ndarray

    @staticmethod
    def new(langs: list[str], units: int = UNITS, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        side = lambda: rng.normal(0, units**-0.5, (units, len(langs))).astype(np.float32)
        return Network(langs, Layer.new(units, rng), Layer.new(units, rng), side(), side(), np.zeros(len(langs), np.float32))

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.hidden, self.backward.inputs, self.backward.hidden, self.out_f, self.out_b, self.bias]

    def label(self, x: np.ndarray, length: np.ndarray, kept: tuple[list, list] | None = None):
        """Probabilities of each language at each position of each word; with kept also the states."""
        mirror = backwards(length, x.shape[1])
        hf = self.forward.run(x, kept and kept[0])
        hb = np.take_along_axis(self.backward.run(np.take_along_axis(x, mirror, 1), kept and kept[1]), mirror[:, :, None], 1)
        z = hf @ self.out_f + hb @ self.out_b + self.bias
        p = np.exp(z - z.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        return (p, hf, hb, mirror) if kept is not None else p

    def gradients(self, x: np.ndarray, length: np.ndarray, lang: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over the letters' positions, and its gradient for each of the weights."""
        kept: tuple[list, list] = ([], [])
        p, hf, hb, mirror = self.label(x, length, kept)
        counted = _LETTER[x] & (np.arange(x.shape[1])[None, :] < length[:, None])
        n = max(int(counted.sum()), 1)
        own = np.take_along_axis(p, lang[:, None, None], 2)[:, :, 0]
        loss = float(-(np.log(own + 1e-12) * counted).sum() / n)
        d = p.copy()
        np.put_along_axis(d, np.broadcast_to(lang[:, None, None], (*own.shape, 1)), (own - 1)[:, :, None], 2)
        d *= (counted / n).astype(np.float32)[:, :, None]
        flat = d.reshape(-1, d.shape[2])
        d_f = self.forward.back(x, kept[0], d @ self.out_f.T)
        d_b = self.backward.back(np.take_along_axis(x, mirror, 1), kept[1], np.take_along_axis(d @ self.out_b.T, mirror[:, :, None], 1))
        units = hf.shape[2]
        return loss, [*d_f, *d_b, hf.reshape(-1, units).T @ flat, hb.reshape(-1, units).T @ flat, flat.sum(0)]


def fit(words: list[bytes], langs: list[str], times: list[int], steps: int = STEPS, seed: int = 7) -> Network | None:
    """A network trained on words with their language, drawn by the root of their count, each language alike; None without any."""
    if not words:
        return None
    names = sorted(set(langs))
    net, rng = Network.new(names, seed=seed), np.random.default_rng(seed)
    label = np.searchsorted(np.array(names), np.array(langs))
    x, length = padded(words)
    weight = np.sqrt(np.array(times, float))
    weight /= np.bincount(label, weight)[label]
    drawn = rng.choice(len(words), size=(steps, min(BATCH, 4 * len(words))), p=weight / weight.sum())
    m, v = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    for t in range(1, steps + 1):  # Adam
        some = drawn[t - 1]
        wide = int(length[some].max())
        _, grads = net.gradients(x[some, :wide], length[some], label[some])
        norm = float(np.sqrt(sum((g * g).sum() for g in grads)))
        rate = RATE * min(1.0, 2 * (1 - t / (steps + 1)))
        for w, g, a, b in zip(net.weights, grads, m, v, strict=True):
            g = g / max(1.0, norm)
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            w -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    return net


class Reader:
    """A network with a bounded table of words that it has labelled."""

    def __init__(self, net: Network, keep: int = KEPT_WORDS):
        self.net, self.keep = net, keep
        self.number: dict[bytes, int] = {}
        self.sums = np.zeros((0, len(net.langs) + 1), np.float64)

    def learn(self, words: list[bytes]) -> None:
        words.sort(key=len)
        parts = [self.sums]
        for k in range(0, len(words), TOGETHER):
            x, length = padded(words[k : k + TOGETHER])
            counted = (_LETTER[x] & (np.arange(x.shape[1])[None, :] < length[:, None]))[:, :, None]
            # rounded, so that no result hangs on which words were labelled together
            parts.append(np.concatenate([(self.net.label(x, length) * counted).sum(1).round(4), counted.sum(1)], 1))
        self.number.update(zip(words, range(len(self.sums), len(self.sums) + len(words)), strict=True))
        self.sums = np.concatenate(parts)

    def read(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        cut = [_WORD.findall(t) if t and has_letter(t) else [] for t in texts]
        if len(self.number) > self.keep:
            self.number, self.sums = {}, self.sums[:0]
        number, out = self.number, []
        if new := {w for words in cut for w in words if w not in number}:
            self.learn(list(new))
        for words in cut:
            if not words:
                out.append(("und", 0.0))
                continue
            total = self.sums[[number[w] for w in words]].sum(0)
            p = total[:-1] / max(total[-1], 1)
            best = int(p.argmax())
            out.append((self.net.langs[best], round(min(max(float(p[best]), 0.0), 1.0), 6)))
        return out

    def positions(self, text: bytes) -> list[str]:
        """The language of each byte of a text."""
        out = []
        for w in _WORD.findall(text):
            x, length = padded([w])
            out += [self.net.langs[k] for k in self.net.label(x, length)[0].argmax(1)]
        return out


def fold(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4


def train(docs: DataFrame, sample: int = SAMPLE, most: int = WORDS, text_col: str = "text", lang_col: str = "lang", steps: int = STEPS) -> Network | None:
    """Fitted on the words of whole texts of at most `sample` documents whose fold is not 2, counted by Spark; the driver gets at most `most` words."""
    known = docs.where(F.col(lang_col).isNotNull() & (fold() != 2)).select("doc_id", F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    chosen = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    picked = known.join(F.broadcast(chosen), known["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi")

    def words(batches):
        from collections import Counter

        import pyarrow as pa

        for b in batches:
            held: dict[str, Counter] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(w for w in _WORD.findall(text or b""))
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "times"])

    counted = picked.mapInArrow(words, "lang string, word binary, times long").groupBy("lang", "word").agg(F.sum("times").alias("times"))
    rows = counted.orderBy(F.xxhash64("word"), "lang").limit(most).collect()
    rows = sorted((bytes(r.word), r.lang, r.times) for r in rows if has_letter(bytes(r.word)))
    return fit(*map(list, zip(*rows, strict=True)), steps=steps) if rows else None


#: The reader of a worker process, kept from task to task of one network.
_READERS: dict[str, Reader] = {}


def identify(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; the network (some 30,000 numbers) is sent along."""
    import uuid

    ids = F.col("doc_id").cast("long").alias("doc_id")
    if net is None:
        return docs.select(ids, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    held, name = docs.sparkSession.sparkContext.broadcast(net), uuid.uuid4().hex

    def work(batches):
        import pyarrow as pa

        if name not in _READERS:
            _READERS.clear()
            _READERS[name] = Reader(held.value)
        reader = _READERS[name]

        def emit(ids, texts):
            langs, scores = zip(*reader.read(texts), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids.append(i)
                texts.append(t.as_py())
                size += len(texts[-1] or b"")
                if size > 1 << 21:
                    yield emit(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield emit(ids, texts)

    return docs.select(ids, F.col(text_col).cast("string").cast("binary").alias("text")).mapInArrow(work, "doc_id long, lang_pred string, score double")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs, train(docs)).select("doc_id", (fold() == 2).alias("held_out"), "lang_pred", "score")
