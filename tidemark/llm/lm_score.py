"""Language-model scoring with a log-frequency Bloom filter.

Documents are dealt into steps of about eight megabytes. Each step sends its distinct tokens, pairs and triples of tokens, with their
counts in training documents, to hash segments. A segment sums them and builds its slice of the filter: a count c enters as its
quantised level 1 + floor(log2 c), the pair (n-gram, j) being a member for each j up to the level, read back by probing j = 1, 2, ...
until a probe fails. A slice has MEMBER_BITS for each member it holds, so that the error rate doesn't rise with the corpus. The filter
has no size bound, so it isn't broadcast but probed where it lies: the segment answers each step with the levels of its n-grams and the
exact counts of its tokens. A false positive lifts a level by one or more at the filter's error rate; nothing is ever lost. Steps are
written in buckets, so that texts are never shuffled; steps and segments follow the bytes of text.

score: sum over tokens w of log10 p(w | u, v), with counts as the filter tells them:
p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)); p(w | v) = (c(v, w) + PRIOR p(w)) / (c(v) + PRIOR); p(w | u, v) = (c(u, v, w) + PRIOR p(w | v)) / (c(u, v) + PRIOR).
A context never seen leaves the shorter one's value. The end of the text before stands before the first token, which has no triple.

The base score takes the exact counts. Tokens are told apart by 96 bits; pairs and triples by 32 bits within their segment, which holds
about a million at any input size, so that one in some thousands is taken for another. They are sent as differences of rising numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

#: Bits of the filter for each member, and of a slice at least; a slice with over FULL of its bits set is an error.
MEMBER_BITS, LEAST_BITS, FULL = 16, 1 << 16, 0.5
PROBES, PRIOR = 3, 4.0

_END = (np.uint64(0x1B873593CC9E2D51), np.uint64(0x9AE16A3B2F90404F))
#: Text bytes of a step, and of a segment's share of the n-grams.
STEP_BYTES, SEGMENT_BYTES = 8 << 20, 4 << 20

_ASKED = pa.schema([("seg", pa.int32()), ("step", pa.int64()), ("h", pa.binary()), ("g", pa.binary()), ("n", pa.binary()), ("ph", pa.binary()), ("pn", pa.binary()), ("px", pa.binary())])
_TOTALS = ("tokens", "kinds", "members", "bits", "absent", "lifted")
_TOLD = pa.schema([("seg", pa.int32()), ("step", pa.int64()), ("counts", pa.binary()), ("levels", pa.binary()), ("long_levels", pa.binary()), *((c, pa.int64()) for c in _TOTALS)])
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean", pa.float64(): "double"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of all tokens (64 and 32 bits), each text's words and then its end; and the first token of each text."""
    one, two, sizes = [], [], []
    for a, b in C.steps(off):
        words = C.Words(data[off[a] : off[b]], off[a : b + 1] - off[a], lower=True)
        at = np.arange(len(words.start)) + words.doc
        for which, out in ((0, one), (1, two)):
            t = np.full(len(words.start) + b - a, _END[which], np.uint64)
            t[at] = words.hashes(which)
            out.append(t if which == 0 else (t >> np.uint64(32)).astype(np.uint32))
        sizes.append(np.diff(words.first) + 1)
    return np.concatenate(one), np.concatenate(two), np.r_[0, np.cumsum(np.concatenate(sizes))]


def _long_grams(t: np.ndarray, first: np.ndarray, segs: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, of a segment's bits and 32 more, of the pair that ends at each token and of the triple that ends there; the latter, at the places given, isn't for first tokens."""
    before = np.empty_like(t)
    before[1:] = t[:-1]
    before[first[:-1]] = _END[0]
    pair = C.fnv_free_mix(before * C.MULT + (t ^ C.MIX1))
    places = np.ones(len(t), bool)
    places[first[:-1]] = False
    places = np.flatnonzero(places)
    triple = C.fnv_free_mix((pair[places - 1] ^ C.MIX2) * C.MULT + t[places])
    drop = np.uint64(32 - (segs.bit_length() - 1))
    return (np.concatenate([pair, triple]) >> drop) << drop, places


def _seg(h: np.ndarray, segs: int) -> np.ndarray:
    return (h >> np.uint64(64 - (segs.bit_length() - 1))).astype(np.int32)


def _packed(h: np.ndarray, n: np.ndarray, segs: int) -> tuple[bytes, bytes, bytes]:
    """A segment's rising hashes as differences of their 32 bits, in the least bytes that hold them all; counts as bytes; and what counts of 255 and more have beyond."""
    low = ((h << np.uint64(segs.bit_length() - 1)) >> np.uint64(32)).astype(np.int64)
    steps = np.diff(low, prepend=0).astype("<u4")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return steps.view(np.uint8).reshape(-1, 4)[:, :width].tobytes(), np.minimum(n, 255).astype(np.uint8).tobytes(), (n[n >= 255] - 255).astype("<i4").tobytes()


def _unpacked(ph: bytes, pn: bytes, px: bytes, seg: int, segs: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.frombuffer(pn, np.uint8).astype(np.int64)
    n[n == 255] += np.frombuffer(px, "<i4")
    steps = np.zeros((len(pn), 4), np.uint8)
    steps[:, : len(ph) // max(1, len(pn))] = np.frombuffer(ph, np.uint8).reshape(len(pn), -1) if len(pn) else 0
    low = np.cumsum(steps.reshape(-1).view("<u4"), dtype=np.uint64)
    bits = segs.bit_length() - 1
    return (low << np.uint64(32 - bits)) | np.uint64(seg << (64 - bits)), n


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key is first met, by rising key, and the rank of each row's key."""
    order = np.argsort(keys[0], kind="stable")
    same = keys[0][order][1:] == keys[0][order][:-1]
    if any((k[order][1:] != k[order][:-1])[same].any() for k in keys[1:]):  # equal first hashes
        order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return order[new], rank


def _places(h: np.ndarray, level: int, width: int) -> list[np.ndarray]:
    """The bits of (n-gram, level) within its segment's slice, of any width."""
    x = C.fnv_free_mix(h + np.uint64((level * int(C.MULT)) & (2**64 - 1)))
    y = C.fnv_free_mix(x ^ C.MIX1) | np.uint64(1)
    return [((x + np.uint64(i) * y) % np.uint64(width)).astype(np.int64) for i in range(PROBES)]


def _levels(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(np.float64))[1]  # 1 + floor(log2 n)


class Slice:
    """A segment's slice of the filter, with MEMBER_BITS for each member unless `width` says otherwise."""

    def __init__(self, h: np.ndarray, level: np.ndarray, width: int = 0):
        self.members = int(level.sum())
        self.bits = np.zeros(width or max(LEAST_BITS, MEMBER_BITS * self.members), bool)
        at = 1
        while len(h):
            for place in _places(h, at, len(self.bits)):
                self.bits[place] = True
            h, level = h[level > at], level[level > at]
            at += 1
        if self.bits.mean() > FULL:
            raise ValueError(f"{self.members} members fill {self.bits.mean():.2f} of {len(self.bits)} bits")

    def levels(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.uint8)
        at = np.arange(len(h))
        for level in range(1, 64):
            good = np.ones(len(at), bool)
            for place in _places(h[at], level, len(self.bits)):
                good &= self.bits[place]
            at = at[good]
            if not len(at):
                break
            out[at] = level
        return out


def _middle(level: np.ndarray) -> np.ndarray:
    """The mean count of a level; 0 for none."""
    return np.where(level > 0, 1.5 * np.exp2(np.maximum(level, 1) - 1.0) - 0.5, 0.0)


def deal(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, held_out) with the step of each row."""

    def number(batches):
        step = TaskContext.get().partitionId() << 36
        for batch in batches:
            _, off = C.utf8(batch.column("text"))
            of = np.zeros(batch.num_rows, np.int64)
            for a, b in C.steps(off, STEP_BYTES):
                of[a:b] = step
                step += 1
            yield pa.RecordBatch.from_arrays([pa.array(of), *(batch.column(c) for c in ("doc_id", "held_out", "text"))], ["step", "doc_id", "held_out", "text"])

    return docs.mapInArrow(number, "step long, doc_id long, held_out boolean, text string")


def _counted(h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, rising, and the sum of their weights."""
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    return h[first], np.add.reduceat(weight[order], first, dtype=np.int32)


def ask(dealt: DataFrame, segs: int) -> DataFrame:
    """Each step's distinct tokens, pairs and triples with their training counts, by segment; a step read in parts asks in parts."""

    def emit(batches):
        for batch in batches:
            data, off = C.utf8(batch.column("text"))
            steps, learnt = batch.column("step").to_numpy(), ~np.array(batch.column("held_out").to_pylist(), bool)
            cuts = np.flatnonzero(np.diff(steps, prepend=-1)) if len(steps) else []

            def rows():
                for a, b in zip(cuts, [*cuts[1:], len(steps)], strict=True):
                    t, g, first = _tokens(data[off[a] : off[b]], off[a : b + 1] - off[a])
                    weight = np.repeat(learnt[a:b], np.diff(first))
                    at, rank = _distinct(t, g)
                    one = {s: x for s, *x in C.by_segment(_seg(t[at], segs), t[at], g[at], np.bincount(rank, weight).astype(np.int32))}
                    grams, places = _long_grams(t, first, segs)
                    grams, n = _counted(grams, np.concatenate([weight, weight[places]]))
                    seg = _seg(grams, segs)
                    ends = np.searchsorted(seg, np.arange(segs + 1))
                    two = {s: _packed(grams[x:y], n[x:y], segs) for s, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if y > x}
                    for s in sorted({*one, *two}):
                        yield s, int(steps[a]), *one.get(s, (b"", b"", b"")), *two.get(s, (b"", b"", b""))

            yield from C.packed(rows(), _ASKED)

    return dealt.mapInArrow(emit, _ddl(_ASKED))


def answer(asked: DataFrame, segs: int) -> DataFrame:
    """For each segment and step the counts of its tokens and the levels of its n-grams, by rising hash; and for each segment a row of
    totals: tokens, kinds, members and bits of its slice, n-grams asked for but not held, and those of them the filter lifts."""

    def reduce(group: pa.Table) -> pa.Table:
        seg, steps = group.column("seg")[0].as_py(), group.column("step").to_numpy()
        column = lambda c, kind: (C.unpack(group.column(c), kind), np.repeat(steps, [len(x) // np.dtype(kind).itemsize for x in group.column(c).to_pylist()]))
        h, of = column("h", np.uint64)
        longs = [_unpacked(*x, seg, segs) for x in zip(*(group.column(c).to_pylist() for c in ("ph", "pn", "px")), strict=True)]
        ph, pn = (np.concatenate(x) for x in zip(*longs, strict=True))
        p_of = np.repeat(steps, [len(x) for x, _ in longs])
        g, n = C.unpack(group.column("g"), np.uint32), C.unpack(group.column("n"), np.int32)
        at, rank = _distinct(h, g)
        count, kind = np.bincount(rank, n, len(at)).astype(np.int64), h[at]
        p_at, p_rank = _distinct(ph)
        p_count, p_kind = np.bincount(p_rank, pn, len(p_at)).astype(np.int64), ph[p_at]
        held, p_held = count > 0, p_count > 0
        found = Slice(np.concatenate([kind[held], p_kind[p_held]]), _levels(np.concatenate([count[held], p_count[p_held]])))
        level, p_level = found.levels(kind), found.levels(p_kind)
        totals = (count.sum(), held.sum(), found.members, len(found.bits), (~held).sum() + (~p_held).sum(), (level[~held] > 0).sum() + (p_level[~p_held] > 0).sum())
        out = [(seg, None, None, None, None, *map(int, totals))]

        def by_step(of, rank):
            """Ranks asked for by each step, rising, each once."""
            key = np.lexsort((rank, of))
            of, rank = of[key], rank[key]
            new = np.ones(len(key), bool)
            new[1:] = (of[1:] != of[:-1]) | (rank[1:] != rank[:-1])
            of, rank = of[new], rank[new]
            cuts = np.flatnonzero(np.diff(of)) + 1
            return {int(of[a]): rank[a:b] for a, b in zip([0, *cuts], [*cuts, len(of)], strict=True) if b > a}

        one, two, none = by_step(of, rank), by_step(p_of, p_rank), np.zeros(0, np.int64)
        for s in {*one, *two}:
            x, y = one.get(s, none), two.get(s, none)
            out.append((seg, s, count[x].tobytes(), level[x].tobytes(), p_level[y].tobytes(), *[None] * len(_TOTALS)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TOLD.types, strict=True)], schema=_TOLD)

    return asked.groupBy("seg").applyInArrow(reduce, _ddl(_TOLD))


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row; learnt from rows not held out.

    docs: doc_id, text, held_out (boolean, no nulls); other columns are ignored. A null or wordless text has one token, its end. Null and
    repeated doc_ids are rows like any others. Without training rows nothing is known, and all tokens have the probability 1 of V = 0.
    An empty table gives no rows. A text of any length is one step, held by one task.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "held_out")
    size = C.text_bytes(rows)
    segs = C.shares(size, SEGMENT_BYTES, 256, 1 << 16)
    dealt = C.staged_buckets(deal(rows), "lm-steps", "step", -(-size // STEP_BYTES))  # the steps' numbers stay
    told = C.staged(answer(ask(dealt, segs), segs), "lm-answers")
    total, kinds = (int(x or 0) for x in told.agg(F.sum("tokens"), F.sum("kinds")).first())
    bottom = total + 0.5 * (kinds + 1)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        data, off = C.utf8(left.column("text"))
        t, g, first = _tokens(data, off)
        n, of = len(off) - 1, np.repeat(np.arange(len(off) - 1), np.diff(first))
        right = right.sort_by("seg")  # a segment is the hash's first bits: answers end to end lie by rising hash
        at, back = _distinct(t, g)
        count = C.unpack(right.column("counts"), np.int64)[back]
        c = _middle(C.unpack(right.column("levels"), np.uint8).astype(np.int64))[back]
        grams, places = _long_grams(t, first, segs)
        _, l_back = _distinct(grams)
        held = _middle(C.unpack(right.column("long_levels"), np.uint8).astype(np.int64))[l_back]
        pair, triple = held[: len(t)], np.zeros(len(t))
        triple[places] = held[len(t) :]
        before = np.empty(len(t))
        before[1:] = c[:-1]
        before[first[:-1]] = c[first[1:] - 1]  # each text's last token is an end
        pair_before = np.zeros(len(t))
        pair_before[places] = pair[places - 1]
        p = (c + 0.5) / bottom
        for seen, context in ((pair, before), (triple, pair_before)):
            p = np.where(context > 0, (np.minimum(seen, context) + PRIOR * p) / (context + PRIOR), p)
        sums = lambda x: np.bincount(of, x, n)
        found = (np.diff(first), sums(count > 0).astype(np.int64), sums(np.log10((count + 0.5) / bottom)), sums(np.log10(np.minimum(p, 1.0))))
        return pa.table([left.column("doc_id"), left.column("held_out"), *map(pa.array, found)], schema=_SCORED)

    answers = told.where("step is not null").select("seg", "step", "counts", "levels", "long_levels")
    out = dealt.groupBy("step").cogroup(answers.groupBy("step")).applyInArrow(score, _ddl(_SCORED))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op7_lm_score(docs: DataFrame) -> DataFrame:
    return score_texts(docs.withColumn("held_out", C.id_remainder("doc_id", 5) == 1))
