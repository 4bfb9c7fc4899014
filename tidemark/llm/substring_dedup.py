"""Substring dedup by repeated-phrase automata.

1. Anchors. Every window of `window` words holds the smallest hash among its `seed`-word phrases; equal windows hold
   equal anchors. Anchors met in two or more documents set bits of a filter of fixed size, which is broadcast: a false
   positive costs work, never a result.
2. Confirmation. Windows under such anchors are gathered by hash; the least document id that holds each is kept, and for
   each shard of documents one document that repeats it. Every map batch pre-aggregates, so a passage shared by a third
   of all documents sends a few entries for each batch.
3. Automata. Documents are dealt to shards. For each shard the anchor phrases of its confirmed windows are compiled into
   one Aho-Corasick automaton, all documents of the shard are streamed through it, and the windows around every
   occurrence are confirmed by a 128-bit hash. Words under a window first seen in a smaller document are removed.

The numbers of shards, segments and tasks follow the bytes of text. Windows are judged on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

#: Bits of the broadcast anchor filter; 16 MB at any input size.
FILTER_BITS = 1 << 27
#: Bytes of text of a shard, which one task holds.
SHARD_BYTES = 4 << 20
#: Windows of a map batch that are pre-aggregated at once.
FLUSH = 1 << 21
#: Shards that a task takes one after another, and tasks of a stage at most.
SHARDS_EACH, TASKS = 4, 100_000

_ANCHORS = "seg int, h binary, lo binary, hi binary"
_SPOTS = "shard int, g binary, doc binary, pos binary, least binary"
_WINDOWS = "seg int, h binary, g binary, lo binary, shard binary, doc binary, pos binary"
_SHARDS = pa.schema([("shard", pa.int32()), ("g", pa.binary()), ("doc", pa.binary()), ("pos", pa.binary()), ("least", pa.binary())])


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _shard_of(ids: np.ndarray, shards: int) -> np.ndarray:
    return (C.fnv_free_mix(ids.astype(np.uint64) + np.uint64(17)) % np.uint64(shards)).astype(np.int32)


def _anchors(words: C.Words, h: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of whole windows, and the anchor hash of each."""
    grams = words.grams(h, seed)
    span = window - seed + 1
    inside = words.inside(window)
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = C.sliding_min(grams, span)[: len(inside)]
    starts = np.flatnonzero(inside)
    return starts, least[starts]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, C.Words]]:
    data, off = C.utf8(batch.column("text"))
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    for a, b in C.steps(off):
        yield ids[a:b], C.Words(data[off[a] : off[b]], off[a : b + 1] - off[a])


def _low_high(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, with its least and greatest document."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    last = np.r_[first[1:] - 1, len(key) - 1] if len(key) else first
    return key[first], doc[first], doc[last]


def _slots(h: np.ndarray, segs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segment of a hash and its two bits within the segment's slice of the filter."""
    seg = (h >> np.uint64(64 - (segs.bit_length() - 1))).astype(np.int64)
    width = np.uint64(max(64, FILTER_BITS // segs))
    return seg, (h & np.uint64(0xFFFFFFF)) % width, ((h >> np.uint64(13)) & np.uint64(0x7FFFFFFF)) % width


def recurring_anchors(docs: DataFrame, window: int, seed: int, segs: int) -> bytearray:
    """The filter of anchors that two or more documents hold: FILTER_BITS bits, whatever the input."""

    def emit(batches):
        for batch in batches:
            keys, owners = [], []
            for ids, words in _parts(batch):
                starts, anchor = _anchors(words, words.hashes(), window, seed)
                doc = ids[words.doc[starts]]
                new = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])] if len(doc) else np.zeros(0, bool)
                keys.append(anchor[new])
                owners.append(doc[new])
            if keys:
                key, lo, hi = _low_high(np.concatenate(keys), np.concatenate(owners))
                yield from C.packed(C.by_segment(_slots(key, segs)[0], key, lo, hi), _schema(_ANCHORS))

    def reduce(group: pa.Table) -> pa.Table:
        key, lo, hi = (C.unpack(group.column(c), t) for c, t in (("h", np.uint64), ("lo", np.int64), ("hi", np.int64)))
        order = np.argsort(key, kind="stable")
        key, lo, hi = key[order], lo[order], hi[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        twice = np.minimum.reduceat(lo, first) < np.maximum.reduceat(hi, first)
        _, one, two = _slots(key[first][twice], segs)
        bits = np.zeros(max(64, FILTER_BITS // segs), bool)
        bits[one.astype(np.int64)] = True
        bits[two.astype(np.int64)] = True
        return pa.table({"seg": group.column("seg")[:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    width = max(64, FILTER_BITS // segs) // 8
    filled = bytearray(width * segs)
    found = docs.mapInArrow(emit, _ANCHORS).repartition(min(TASKS, max(1, segs // SHARDS_EACH)), "seg").groupBy("seg").applyInArrow(reduce, "seg int, bits binary")
    for seg, bits in found.toLocalIterator():  # FILTER_BITS in all
        filled[seg * width : (seg + 1) * width] = bits
    return filled


def _known(bits: np.ndarray, h: np.ndarray, segs: int) -> np.ndarray:
    width = max(64, FILTER_BITS // segs)
    seg, one, two = _slots(h, segs)

    def test(slot):
        at = seg * width + slot.astype(np.int64)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1

    return (test(one) & test(two)).astype(bool)


def confirmed_windows(docs: DataFrame, window: int, seed: int, segs: int, groups: int, shards: int) -> DataFrame:
    """For each repeated window and shard, one place in that shard that repeats it: shard, doc, pos, least (packed)."""
    known = docs.sparkSession.sparkContext.broadcast(bytes(recurring_anchors(docs, window, seed, segs)))

    def aggregated(parts: list[tuple]) -> Iterator[tuple]:
        """Of each window and shard its two smallest documents at most, for the smallest of all may be one of them."""
        g, g2, doc, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(g):
            return
        shard = _shard_of(doc, shards)
        order = np.lexsort((pos, doc, shard, g))
        g, g2, doc, pos, shard = (x[order] for x in (g, g2, doc, pos, shard))
        once = np.r_[True, (g[1:] != g[:-1]) | (shard[1:] != shard[:-1]) | (doc[1:] != doc[:-1])]
        g, g2, doc, pos, shard = (x[once] for x in (g, g2, doc, pos, shard))
        same = np.r_[False, (g[1:] == g[:-1]) & (shard[1:] == shard[:-1])]
        third = np.r_[np.zeros(min(2, len(g)), bool), same[2:] & same[1:-1]]
        g, g2, doc, pos, shard = (x[~third] for x in (g, g2, doc, pos, shard))
        yield from C.by_segment(_slots(g, groups)[0], g, g2, doc, shard, doc, pos.astype(np.int32))

    def emit(batches):
        bits = np.frombuffer(known.value, np.uint8)
        for batch in batches:
            parts, held = [], 0
            for ids, words in _parts(batch):
                h = words.hashes()
                starts, anchor = _anchors(words, h, window, seed)
                new = np.r_[True, anchor[1:] != anchor[:-1]] if len(anchor) else np.zeros(0, bool)
                runs = np.cumsum(new) - 1
                keep = _known(bits, anchor[new], segs)[runs] if len(anchor) else new
                at = starts[keep]
                parts.append((words.grams(h, window)[at], words.grams(words.hashes(1), window, 1)[at], ids[words.doc[at]], at - words.first[words.doc[at]]))
                held += len(at)
                if held >= FLUSH:
                    yield from C.packed(aggregated(parts), _schema(_WINDOWS))
                    parts, held = [], 0
            if parts:
                yield from C.packed(aggregated(parts), _schema(_WINDOWS))

    def reduce(group: pa.Table) -> pa.Table:
        g, g2, doc, shard, pos = (C.unpack(group.column(c), t) for c, t in (("h", np.uint64), ("g", np.uint64), ("lo", np.int64), ("shard", np.int32), ("pos", np.int32)))
        order = np.lexsort((pos, doc, g2, g))
        g, g2, doc, shard, pos = (x[order] for x in (g, g2, doc, shard, pos))
        first = np.r_[True, (g[1:] != g[:-1]) | (g2[1:] != g2[:-1])]
        least = doc[np.flatnonzero(first)][np.cumsum(first) - 1]
        late = doc > least
        if not late.any():
            return _SHARDS.empty_table()
        run, g, doc, shard, pos, least = (x[late] for x in (np.cumsum(first), g, doc, shard, pos, least))
        order = np.lexsort((doc, shard, run))
        run, g, doc, shard, pos, least = (x[order] for x in (run, g, doc, shard, pos, least))
        one = np.r_[True, (run[1:] != run[:-1]) | (shard[1:] != shard[:-1])]
        rows = list(C.by_segment(shard[one], g[one], doc[one], pos[one], least[one]))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SHARDS.types, strict=True)], schema=_SHARDS)

    return docs.mapInArrow(emit, _WINDOWS).repartition(min(TASKS, max(1, groups // SHARDS_EACH)), "seg").groupBy("seg").applyInArrow(reduce, _SPOTS)


def _locate(texts: list[bytes], ids: np.ndarray, g: np.ndarray, doc: np.ndarray, pos: np.ndarray, least: np.ndarray, window: int, seed: int) -> tuple[list[np.ndarray | None], int]:
    """For each document of a shard, which of its words go (None: no word), by an automaton of the shard's phrases."""
    n = len(texts)
    gone: list[np.ndarray | None] = [None] * n
    if not len(doc):
        return gone, 0
    off = np.r_[0, np.cumsum([len(t) for t in texts])]
    words = C.Words(np.frombuffer(b"".join(texts), np.uint8), off)
    h = words.hashes()
    one, two = words.grams(h, window), words.grams(words.hashes(1), window, 1)
    grams = words.grams(h, seed)
    by_id = np.argsort(ids, kind="stable")
    place = np.searchsorted(ids[by_id], doc)
    start = words.first[by_id[place]] + pos
    for i in np.flatnonzero(one[np.minimum(start, len(one) - 1)] != g).tolist():  # several rows with one doc_id: find the row meant
        k = place[i]
        while one[min(start[i], len(one) - 1)] != g[i]:
            k += 1
            start[i] = words.first[by_id[k]] + pos[i]
    # the phrase at a window's anchor
    span = window - seed + 1
    anchor = C.sliding_min(grams, span)[start]
    order = np.argsort(anchor, kind="stable")
    fresh = order[np.r_[True, anchor[order][1:] != anchor[order][:-1]]]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for s, a in zip(start[fresh].tolist(), anchor[fresh], strict=True):
        at = s + int(np.argmax(grams[s : s + span] == a))
        r = int(words.doc[at])
        phrase = b" ".join(texts[r][words.start[i] - off[r] : words.end[i] - off[r]] for i in range(at, at + seed))
        automaton.add_word(" " + phrase.decode("latin-1") + " ")
    automaton.make_automaton()
    # confirmed windows, by both hashes
    order = np.lexsort((two[start], one[start]))
    k1, k2, low = one[start][order], two[start][order], least[order]
    for r in range(n):
        a, b = int(words.first[r]), int(words.first[r + 1])
        if b - a < window:
            continue
        split = texts[r].split()
        ends = [e for e, _ in automaton.iter(" " + b" ".join(split).decode("latin-1") + " ")]
        if not ends:
            continue
        length = np.fromiter(map(len, split), np.int64, b - a)
        close = np.cumsum(length + 1)  # place of the space after each word
        last = np.searchsorted(close, np.asarray(ends))
        mark = np.zeros(b - a + 1, np.int64)
        np.add.at(mark, np.maximum(last - window + 1, 0), 1)
        np.add.at(mark, last - seed + 2, -1)
        near = np.flatnonzero(np.cumsum(mark)[: b - a - window + 1] > 0)
        w1, w2 = one[a + near], two[a + near]
        at = np.searchsorted(k1, w1)
        hit = np.zeros(len(near), bool)
        open_ = np.flatnonzero(at < len(k1))
        while len(open_):  # equal first hashes, should there be any, are walked
            open_ = open_[k1[at[open_]] == w1[open_]]
            good = k2[at[open_]] == w2[open_]
            hit[open_[good]] = low[at[open_[good]]] < ids[r]
            open_ = open_[~good]
            at[open_] += 1
            open_ = open_[at[open_] < len(k1)]
        if hit.any():
            cover = np.zeros(b - a + 1, np.int64)
            cover[near[hit]] += 1
            np.add.at(cover, near[hit] + window, -1)
            gone[r] = np.cumsum(cover)[: b - a] > 0
    return gone, len(fresh)


def dedup_substrings(docs: DataFrame, window: int = 50, seed: int = 8) -> DataFrame:
    """Remove every word covered by a `window`-word passage that also starts in a document with a smaller doc_id.

    docs: doc_id (integer), text; other columns are ignored. Returns doc_id, n_words, n_removed, kept_text.
    Null text: no words, and kept_text is empty. Null doc_id: the row is returned whole; it takes no part, having no place in the order. Rows with
    the same doc_id are one document in the order: they don't remove each other's words. Texts under `window` words,
    and empty tables, come back unchanged. Words are joined by one space. Passages within one document stay.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.where("doc_id is not null")
    size = C.text_bytes(known)
    shards, segs = max(16, size // SHARD_BYTES), C.shares(size, SHARD_BYTES, 16, 1 << 14)
    spots = confirmed_windows(known, window, seed, segs, C.shares(size, SHARD_BYTES, 16, 1 << 20), shards)
    tasks = min(TASKS, max(1, shards // SHARDS_EACH))
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("doc_id").to_numpy()
        texts = [(t or "").encode() for t in left.column("text").to_pylist()]
        g, doc, pos, least = (C.unpack(right.column(c), t) for c, t in (("g", np.uint64), ("doc", np.int64), ("pos", np.int32), ("least", np.int64)))
        gone, _ = _locate(texts, ids, g, doc, pos.astype(np.int64), least, window, seed)
        rows = []
        for i, text, cut in zip(ids.tolist(), texts, gone, strict=True):
            words = text.split()
            kept = words if cut is None else [w for w, x in zip(words, cut.tolist(), strict=True) if not x]
            rows.append((i, len(words), len(words) - len(kept), b" ".join(kept).decode()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), out.types, strict=True)], schema=out) if rows else out.empty_table()

    def shard_column(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_shard_of(ids, shards), pa.int32()), *batch.columns], ["shard", "doc_id", "text"])

    dealt = known.mapInArrow(shard_column, "shard int, doc_id long, text string")
    found = dealt.repartition(tasks, "shard").groupBy("shard").cogroup(spots.repartition(tasks, "shard").groupBy("shard")).applyInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), C.SPACE_PATTERN), lambda w: w != "")
    rest = docs.where("doc_id is null").select("doc_id", F.size(words).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.array_join(words, " ").alias("kept_text"))
    return found.unionByName(rest)


def op1_substring_dedup(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, unnest(range(1, len(w) - 48)) as i, w from d where len(w) >= 50),
met as (select doc_id, i, min(doc_id) over (partition by array_to_string(w[i:i+49], ' ')) as least from win),
cov as (select doc_id, list(distinct k) as gone from (select doc_id, unnest(range(i, i + 50)) as k from met where least < doc_id) group by doc_id),
x as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as k from d),
kept as (select x.doc_id, string_agg(word, ' ' order by k) as t, count(*) as n from x left join cov using (doc_id) where gone is null or not list_contains(gone, k) group by x.doc_id)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""
