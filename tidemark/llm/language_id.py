"""Language identification by prediction by partial matching over bytes.

For each language a byte context tree of orders 3 to 0 is counted over a bounded sample of labelled documents and then frozen.
A byte's code length in a context where it was seen c times of n, among d distinct bytes, is -log2(c / (n + d)); else the
escape -log2(d / (n + d)) is paid and the next shorter context is asked; below order 0 all bytes are equally likely.
A document gets the language of least total code length over all its bytes. Every context that was seen is kept, and all bytes are told apart.

The code lengths of some languages lie side by side: for every sequence of four or three bytes that one of them saw, and for every pair.
Languages are dealt to models of about MODEL_BYTES, one language at least, each of which is broadcast; documents pass through one model after
the other, carrying the best language so far, and don't move.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tidemark.llm import common as C

#: Labelled documents a language is learnt from, chosen by a hash of their text.
SAMPLE = 2000
#: Languages up to which their sizes are broadcast; beyond it the join is a shuffle.
BROADCAST_LANGS = 100_000
#: Bytes of the languages that are broadcast at once.
MODEL_BYTES = 48 << 20
#: Stands before a text; no byte of UTF-8 has this value.
BEFORE = 0xFF


def labelled_sample(docs: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Up to `most` distinct texts of each lang, by their hash; first thinned by the rate of distinct texts, so that no long group is sorted."""
    rows = docs.where("lang is not null and text is not null").withColumn("__h", F.xxhash64("text"))
    sizes = C.staged(rows.select("lang", "__h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("__n")), "language-sizes")
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_LANGS else sizes
    rate = F.least(F.lit(1.0), 2.0 * most / F.col("__n"))
    thin = rows.join(sizes, "lang").where((F.pmod("__h", F.lit(1 << 20)) < rate * (1 << 20)) | (F.col("__n") <= 2 * most))
    thin = thin.dropDuplicates(["lang", "__h"])  # a text copied many times counts once
    order = Window.partitionBy("lang").orderBy("__h")
    return thin.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= most).select("lang", "text")


def _contexts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Each byte with the three before it in its text, the oldest first, as one number."""
    at = np.arange(len(data)) - np.repeat(off[:-1], np.diff(off))
    out = data.astype(np.uint32)
    for k in (1, 2, 3):
        before = np.full(len(data), BEFORE, np.uint32)
        before[k:] = data[: len(data) - k]
        before[at < k] = BEFORE
        out |= before << np.uint32(8 * k)
    return out


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and their sums."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


def _found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a rising table, and which are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class Tree:
    """One language's counts. keys[k], n[k]: sequences of k + 1 bytes; contexts[k], total[k], kinds[k]: what precedes their last byte."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.keys, self.n, self.contexts, self.total, self.kinds = [], [], [], [], []
        for k in range(4):
            keys, count = _summed(grams & np.uint32((1 << 8 * (k + 1)) - 1), n)
            contexts, total = _summed(keys >> np.uint32(8), count)
            _, kinds = _summed(keys >> np.uint32(8), np.ones(len(keys)))
            for have, new in ((self.keys, keys), (self.n, count), (self.contexts, contexts), (self.total, total), (self.kinds, kinds)):
                have.append(new)

    def escape(self, k: int, contexts: np.ndarray) -> np.ndarray:
        """Bits paid to leave contexts of k bytes; none if it was never seen."""
        at, seen = _found(self.contexts[k], contexts)
        total, kinds = self.total[k][at] if len(self.total[k]) else 1.0, self.kinds[k][at] if len(self.kinds[k]) else 1.0
        return np.where(seen, -np.log2(kinds / (total + kinds)), 0.0)

    def lengths(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Code lengths of sequences of k + 1 bytes, in contexts of k bytes and shorter."""
        if k < 0:
            return np.full(len(keys), np.log2(255.0))
        below = self.lengths(k - 1, keys & np.uint32((1 << 8 * k) - 1 if k else 0))
        at, seen = _found(self.keys[k], keys)
        c_at, _ = _found(self.contexts[k], keys >> np.uint32(8))
        out = self.escape(k, keys >> np.uint32(8)) + below
        if seen.any():
            own = -np.log2(self.n[k][at] / (self.total[k][c_at] + self.kinds[k][c_at]))
            out[seen] = own[seen]
        return out

    def size(self) -> int:
        return 4 * (65536 + sum(len(self.keys[k]) + len(self.contexts[k]) for k in (2, 3)))


class Model:
    """Frozen code lengths of some languages. Sequences of four or three bytes that none has seen cost the escapes and the next shorter one."""

    def __init__(self, langs: list[str], trees: list[Tree]):
        self.langs, self.keys, self.bits, self.contexts, self.escapes = langs, {}, {}, {}, {}
        side = lambda x: np.stack(x, 1).astype(np.float32)
        for k in (2, 3):
            self.keys[k] = np.unique(np.concatenate([t.keys[k] for t in trees]))
            self.bits[k] = side([t.lengths(k, self.keys[k]) for t in trees])
            self.contexts[k] = np.unique(np.concatenate([t.contexts[k] for t in trees]))
            self.escapes[k] = side([t.escape(k, self.contexts[k]) for t in trees])
        self.pairs = side([t.lengths(1, np.arange(65536, dtype=np.uint32)) for t in trees])

    def _bits(self, k: int, keys: np.ndarray) -> np.ndarray:
        if k == 1:
            return self.pairs[keys]
        at, seen = _found(self.keys[k], keys)
        out = self.bits[k][at]
        if not seen.all():
            new = keys[~seen]
            c_at, known = _found(self.contexts[k], new >> np.uint32(8))
            out[~seen] = np.where(known[:, None], self.escapes[k][c_at], 0) + self._bits(k - 1, new & np.uint32((1 << 8 * k) - 1))
        return out

    def lengths(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Code length in bits of each text under each language."""
        bits = self._bits(3, _contexts(data, off))
        out = np.zeros((len(off) - 1, len(self.langs)))
        some = np.flatnonzero(np.diff(off))
        if len(some):
            out[some] = np.add.reduceat(bits, off[some], axis=0, dtype=np.float64)
        return out


def train(sample: DataFrame, most: int = MODEL_BYTES) -> Iterator[Model]:
    """Models of a sample (lang, text), each of about `most` bytes or one language. One language's counts at a time reach the driver."""

    def grams(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            data, off = C.utf8(batch.column("text"))
            for a, b in C.steps(off):
                g = _contexts(data[off[a] : off[b]], off[a : b + 1] - off[a])
                owner = np.repeat(langs[a:b], np.diff(off[a : b + 1]))
                for lang in sorted(set(langs[a:b])):
                    key, n = np.unique(g[owner == lang], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.astype(np.int64)), pa.array(n, pa.int64())], ["lang", "g", "n"])

    counts = C.staged(sample.mapInArrow(grams, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")), "language-counts")
    names, trees = [], []
    for r in counts.select("lang").distinct().sort("lang").toLocalIterator():
        got = counts.where(F.col("lang") == r["lang"]).select("g", "n").toArrow()  # at most SAMPLE documents
        tree = Tree(got.column("g").to_numpy().astype(np.uint32), got.column("n").to_numpy().astype(np.float64))
        if names and (len(names) + 1) * sum(t.size() for t in [*trees, tree]) > most:
            yield Model(names, trees)
            names, trees = [], []
        names, trees = [*names, r["lang"]], [*trees, tree]
    if names:
        yield Model(names, trees)


def predict(docs: DataFrame, models: Iterable[Model], text: str = "text") -> DataFrame:
    """docs (whose columns' names don't begin with two underscores) with lang_pred and score (0 to 1): the best language's share of likelihood, all being equally likely before."""
    state = [T.StructField("__lang", T.StringType()), T.StructField("__best", T.DoubleType()), T.StructField("__rest", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *state])
    out = docs.withColumns({f.name: F.lit(None).cast(f.dataType) for f in state})
    for model in models:
        out = out.mapInArrow(_pass(docs.sparkSession.sparkContext.broadcast(model), text), schema)
    # __rest: sum of 2 ** (__best - bits) over all languages met, which is 1 for the best itself
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)) & F.col("__lang").isNotNull()
    return out.select(*docs.columns, F.when(lettered, F.col("__lang")).otherwise("und").alias("lang_pred"), F.when(lettered, 1 / F.col("__rest")).otherwise(0.0).alias("score"))


def _pass(shared, text: str):
    """One model's turn: the best language of those met so far, its bits, and the sum of likelihoods relative to it."""

    def run(batches):
        m = shared.value
        for batch in batches:
            data, off = C.utf8(batch.column(text))
            bits = np.concatenate([np.zeros((0, len(m.langs))), *(m.lengths(data[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in C.steps(off))])
            at, least = bits.argmin(1), bits.min(1)
            before = batch.column("__best").to_numpy(zero_copy_only=False).astype(np.float64)
            before, rest = np.where(np.isnan(before), np.inf, before), np.nan_to_num(batch.column("__rest").to_numpy(zero_copy_only=False).astype(np.float64))
            better = least < before
            best = np.minimum(least, before)
            share = lambda x: np.exp2(np.maximum(best - x, -1000))
            total = np.where(rest > 0, rest * share(np.where(np.isinf(before), best, before)), 0) + share(bits.T).sum(0)
            lang = np.where(better, np.array(m.langs, object)[at], np.array(batch.column("__lang").to_pylist(), object))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], pa.array(lang, pa.string()), pa.array(best), pa.array(total)], batch.schema.names)

    return run


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; learnt from text and lang of rows not held out.

    lang_pred is `und` (score 0) for a null text, one without a letter, or with no labelled row to learn from. Rows with a
    null lang are predicted but not learnt from; a null doc_id isn't held out. Ties go to the first language by name; repeated rows get equal results.
    Texts are read whole, to the last byte.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out.alias("held_out"))
    sample = C.staged(labelled_sample(rows.where(~F.col("held_out")).select("text", "lang")), "language-sample")
    return predict(rows.select("doc_id", "held_out", "text"), train(sample)).select("doc_id", "held_out", "lang_pred", "score")


def op2_language_id(docs: DataFrame) -> DataFrame:
    return identify(docs, C.id_remainder("doc_id", 4) == 2)
