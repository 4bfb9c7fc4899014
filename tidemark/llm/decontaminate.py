"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame operations only.

Texts are lower case words; a shingle is five words, or the whole item where it is shorter. Every window with as many shingles as an item
is fingerprinted, for each such number. Windows are looked up in blocks of 8 bits: two fingerprints within RADIUS = 23 bits have a block in
which they differ in at most two, so each item is stored under every value within two bits of each of its eight blocks, and none within
the radius is lost. Candidates come from the blocks alone; those within the radius are verified by exact weighted Jaccard similarity, a
shingle's weight being its count.

At similarity 0.8 two fingerprints differ in 10 bits on average, with a deviation of 3; the radius is over four deviations beyond.

Each place of a text is a row of a generator within one compiled stage. It adds the shingles from that place on, one by one, to bit planes
that count all 64 bits at once: some 20 operations on longs a shingle, and one for each plane to compare them with half of an item's
number. Items of over LADDER shingles take planes of 1, 2, 4, ... shingles as arrays instead, which is slower. Blocks, and bits of the
items' shingles for a bound before verification, are one broadcast row; the fingerprints of at most ITEMS items are in the code, and the
documents are read once for each such part. No document moves. `Index` is the same search over words in memory, for few texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C

RADIUS, BLOCK = 23, 8
#: Shingles of the items searched for in one pass: 4 MB of their bits.
PART_SHINGLES = 1 << 21
#: Items searched for in one pass over the documents, and the longest whose windows are counted step by step.
ITEMS, LADDER = 512, 127
#: Places of which the windows are handled at once: 4 MB of sums.
PLACES = 1 << 16

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_FLIPS = np.array([0, *[1 << i for i in range(BLOCK)], *[(1 << i) | (1 << j) for i in range(BLOCK) for j in range(i)]], np.uint8)


def _votes(h: np.ndarray) -> np.ndarray:
    """Running sums of votes, 1 for a bit and -1 for none, modulo 2**64: row j has bits j, 8 + j, 16 + j, ... of the hashes in bytes of one number."""
    out = np.zeros((8, len(h) + 1), np.uint64)
    for j in range(8):
        np.cumsum(((h >> np.uint64(j)) & _ONES) * np.uint64(2) - _ONES, out=out[j, 1:])
    return out


def fingerprints(votes: np.ndarray, n: int, raised: np.ndarray | None = None) -> np.ndarray:
    """SimHash of the windows of n shingles; a bit is 1 if over half of them have it.

    The votes of a window are a difference of running sums. With 127 added to each byte (`raised`: the sums with it) they don't borrow
    from each other while n < 128, and a byte's highest bit is the answer. Larger windows add parts under 128, bit by bit.
    """
    m = max(0, votes.shape[1] - n)
    out = np.zeros(m, np.uint64)
    raised = votes + _ONES * np.uint64(127) if raised is None else raised
    if n < 128:
        x = np.empty(m, np.uint64)
        for j in range(8):
            np.subtract(raised[j, n : n + m], votes[j, :m], out=x)
            x &= _HIGH
            out >>= np.uint64(1)
            out |= x
        return out
    for j in range(8):
        for b in range(8):
            count = np.zeros(m, np.int64)
            for a in range(0, n, 127):
                z = min(n, a + 127)
                count += (((raised[j, z : z + m] - votes[j, a : a + m]) >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64) - 127
            out |= (count > 0).astype(np.uint64) << np.uint64(8 * b + j)
    return out


def simhash(h: np.ndarray) -> int:
    return int(fingerprints(_votes(h), len(h))[0])


def block_bits(prints: np.ndarray) -> np.ndarray:
    """For up to 64 fingerprints: by block and value, the bits of those whose own value there lies within two bits."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if len(prints) <= 8 * k().itemsize)
    one = np.zeros((64 // BLOCK, 1 << BLOCK), kind)
    for k, own in enumerate(prints.view(np.uint8).reshape(-1, 64 // BLOCK)):
        for b, v in enumerate(own):
            one[b, v ^ _FLIPS] |= kind(1 << k)
    return one


def block_tables(prints: np.ndarray) -> np.ndarray:
    """The bits of two blocks that lie side by side share a row, which has those of both for each of their values together."""
    one = block_bits(prints)
    return np.ascontiguousarray((one[1::2, :, None] | one[::2, None, :]).reshape(64 // BLOCK // 2, -1))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle lists."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = int(np.minimum(n[i], m[j]).sum())
    return shared / (len(a) + len(b) - shared)


@dataclass
class Group:
    """Up to 64 items with equal shingle width and number of shingles."""

    width: int
    n: int
    at: list[int]
    prints: np.ndarray
    tables: np.ndarray
    shingles: list[np.ndarray]


def _shingles(words: C.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles that start at each word, and which of them lie in one text."""
    return words.grams(words.hashes(), width), words.inside(width)


class Index:
    """Items (their words as one text each) grouped by size, with block tables."""

    def __init__(self, texts: list[str], shingle: int):
        by_size: dict[tuple[int, int], list[int]] = {}
        found: list[np.ndarray] = []
        for i, t in enumerate(texts):
            raw = t.encode()
            words = C.Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            width = min(shingle, len(words.start))
            found.append(_shingles(words, width)[0])
            by_size.setdefault((width, len(found[i])), []).append(i)
        self.groups = [self._group(w, n, own[a : a + 64], found) for (w, n), own in sorted(by_size.items()) for a in range(0, len(own), 64)]

    @staticmethod
    def _group(width: int, n: int, at: list[int], found: list[np.ndarray]) -> Group:
        prints = np.array([simhash(found[i]) for i in at], np.uint64)
        return Group(width, n, at, prints, block_tables(prints), [found[i] for i in at])

    def search(self, words: C.Words, least: float) -> Iterator[tuple[int, int, float, int]]:
        """(text, item, similarity, start) of each text and item whose best window has at least `least`; of equal windows the first."""
        for width in sorted({g.width for g in self.groups}):
            h, inside = _shingles(words, width)
            if len(h):
                yield from self._search(words, h, inside, [g for g in self.groups if g.width == width], least)

    def _search(self, words: C.Words, h: np.ndarray, inside: np.ndarray, groups: list[Group], least: float) -> Iterator[tuple[int, int, float, int]]:
        h = np.where(inside, h, np.uint64(0))
        first = words.first
        best: dict[tuple[int, int], tuple[float, int]] = {}
        known = None
        longest = max(g.n for g in groups)
        for a in range(0, len(h), PLACES):
            votes = _votes(h[a : a + PLACES + longest - 1])
            raised = votes + _ONES * np.uint64(127)
            for g in groups:
                fp = fingerprints(votes[:, : PLACES + g.n], g.n, raised)
                if not len(fp):
                    continue
                values = fp.view("<u2").reshape(-1, 4).T.astype(np.intp)
                met = g.tables[0].take(values[0], mode="clip")
                for table, value in zip(g.tables[1:], values[1:], strict=True):
                    met |= table.take(value, mode="clip")
                for k in range(len(g.at)):
                    near = np.bitwise_count(fp ^ g.prints[k]) <= RADIUS
                    near &= (met & met.dtype.type(1 << k)) != 0
                    start = np.flatnonzero(near) + a
                    if not len(start):
                        continue
                    # verification, first by a bound: shingles of any item in the window
                    if known is None:
                        every = np.unique(np.concatenate([s for x in groups for s in x.shingles]))
                        place = np.minimum(np.searchsorted(every, h), len(every) - 1)
                        known = np.r_[0, np.cumsum(every[place] == h)]
                    enough = 2 * least / (1 + least) * g.n - 1e-9
                    start = start[known[start + g.n] - known[start] >= enough]
                    for s in start.tolist():
                        doc = int(words.doc[s])
                        if s + g.n + g.width - 1 > first[doc + 1]:
                            continue  # reaches into the next text
                        found = similarity(g.shingles[k], h[s : s + g.n])
                        if found >= least and found > best.get((doc, g.at[k]), (0.0, 0))[0]:
                            best[doc, g.at[k]] = (found, s - int(first[doc]))
        yield from ((doc, item, found, start) for (doc, item), (found, start) in best.items())


SPACES = "' \\t\\n\\u000b\\u000c\\r'"


def _words(text: str) -> list[tuple[str, str]]:
    """Steps (column, SQL) from a text to its words `w`; a null text has none."""
    return [("t", f"btrim(lower(coalesce(cast({text} as string), '')), {SPACES})"), ("w", f"if(t = '', cast(array() as array<string>), split(t, r'{C.SPACE_PATTERN}'))")]


def _sequences(width: int) -> list[tuple[str, str]]:
    """Steps from words `w` to the hashes `h` of the sequences of `width` words."""
    later = "".join(f", get(hw, i + {k})" for k in range(1, width))
    return [("hw", "transform(w, x -> xxhash64(x))"), ("h", f"slice(transform(hw, (x, i) -> xxhash64(x{later})), 1, greatest(0, size(hw) - {width - 1}))")]


def _stepped(df: DataFrame, keep: list[str], steps: list[tuple[str, str]]) -> DataFrame:
    for name, sql in steps:
        df = df.selectExpr(*keep, f"{sql} as {name}")
        keep = [*keep, name]
    return df


def _signed(x: np.ndarray) -> list[int]:
    return np.asarray(x, np.uint64).view(np.int64).tolist()


@dataclass
class Part:
    """Items of one width, a bounded number of them, as columns of one row that is broadcast."""

    width: int
    groups: list[Group]
    bits: int

    def row(self, spark) -> DataFrame:
        """`ix`: bits of all shingles of the items, then for each group and block the items with each value within two bits of theirs."""
        every = np.unique(np.concatenate([s for g in self.groups for s in g.shingles]))
        bm = np.zeros(1 << (self.bits - 6), np.uint64)
        np.bitwise_or.at(bm, (every >> np.uint64(70 - self.bits)).astype(np.intp), np.uint64(1) << (every & np.uint64(63)))
        tb = np.concatenate([block_bits(g.prints).astype(np.uint64).ravel() for g in self.groups])
        longs = T.ArrayType(T.LongType(), False)
        return spark.createDataFrame([(_signed(np.concatenate([bm, tb])),)], T.StructType([T.StructField("ix", longs, False)]))

    def known(self, x: str) -> str:
        """1 if the bits have shingle x: it may be one of an item's."""
        return f"cast(shiftrightunsigned(ix[shiftrightunsigned({x}, {70 - self.bits})], cast({x} & 63 as int)) & 1 as int)"

    def met(self, g: int) -> str:
        """Bits of the items of group g that fp meets in a block."""
        own = (1 << (self.bits - 6)) + (g * (64 // BLOCK) << BLOCK)
        return " | ".join(f"ix[{own + (b << BLOCK)}L | (shiftrightunsigned(fp, {b * BLOCK}) & {(1 << BLOCK) - 1})]" for b in range(64 // BLOCK))

    def near(self, g: int) -> str:
        return "(" + " or ".join(f"((met & {_signed(np.array([1 << k]))[0]}L) <> 0 and bit_count(fp ^ {_long(x)}) <= {RADIUS})" for k, x in enumerate(_signed(self.groups[g].prints))) + ")"


def _long(x: int) -> str:
    return f"{x}L" if x > -(1 << 63) else "(-9223372036854775807L - 1L)"


def _half(planes: list[str], n: int) -> str:
    """SQL of the bits of which the count, given as bit planes, is over half of n."""
    least, out = n // 2 + 1, "-1L"
    for b, plane in enumerate(planes):
        out = f"({plane} {'&' if least >> b & 1 else '|'} {out})"
    return out


def _enough(n: int, least: float) -> int:
    return math.ceil(2 * least / (1 + least) * n - 1e-9)


def _candidates(docs: DataFrame, part: Part, least: float) -> DataFrame:
    """who, k, fp, start, win: the windows that meet an item of group k in a block and lie within the radius of it.

    docs: who, h. Each place of a text adds the shingles from it on to bit planes, which count all 64 bits at once, and compares them at
    the number of shingles of each group. Every step is a projection that uses each column at least twice: Spark then makes it a function
    of its own, which the JVM compiles.
    """
    at = {g.n: [] for g in part.groups}
    for k, g in enumerate(part.groups):
        at[g.n].append(k)
    kind = f"array<struct<who:{docs.schema['who'].dataType.simpleString()},k:int,fp:bigint,start:int,win:array<bigint>>>"
    shortest, longest = min(at), max(at)
    places = docs.selectExpr("who", "h", f"explode_outer(if(size(h) >= {shortest}, sequence(0, size(h) - {shortest}), cast(array() as array<int>))) as p").where("p is not null")
    shingle = lambda i: f"coalesce(get(h, p + {i}), 0L) as x"
    df = places.crossJoin(F.broadcast(part.row(docs.sparkSession))).selectExpr("who", "h", "p", "ix", f"cast(array() as {kind}) as hits", "0 as known", shingle(0))
    planes: list[str] = []
    fixed = ["who", "h", "p", "ix"]
    for n in range(longest + 1):
        hits = "hits"
        for k in at.get(n, []):
            df = df.selectExpr(*fixed, hits, "known", "x", *planes, f"{_half(planes, n)} as fp")
            df = df.selectExpr(*fixed, "hits", "known", "x", *planes, "fp", f"{part.met(k)} as met")
            found = f"met <> 0 and known >= {_enough(n, least)} and p + {n} <= size(h) and {part.near(k)}"
            hits = f"if({found}, concat(hits, array(named_struct('who', who, 'k', {k}, 'fp', fp, 'start', p, 'win', slice(h, p + 1, {n})))), hits) as hits"
        if n not in at and n % 4 == 0:  # never so: the same uses of all columns
            hits = f"if(known < 0, concat(hits, array(named_struct('who', who, 'k', 0, 'fp', x, 'start', p, 'win', h))), hits) as hits"
        if n == longest:
            return df.selectExpr("inline_outer(" + hits.removesuffix(" as hits") + ")").where("k is not null")
        carry, after = "x", []
        for plane in planes:
            after.append(f"{plane} ^ {carry} as {plane}")
            before = carry
            carry = f"({carry} & {plane})"
        if n + 1 >> len(planes):
            after.append(f"{carry} as q{len(planes)}")
            planes = [*planes, f"q{len(planes)}"]
        else:  # nothing is carried out of the last plane: exclusive or with two uses
            top = planes[-1]
            after[-1] = f"({top} | {before}) & ~({top} & {before}) as {top}"
        df = df.selectExpr(*fixed, hits, f"known + {part.known('x')} as known", shingle(n + 1), *after)
    raise AssertionError


def _long_candidates(docs: DataFrame, part: Part, least: float) -> DataFrame:
    """As _candidates, for one group of any size: bit planes of windows of 1, 2, 4, ... shingles as arrays over a text, added up to n."""
    (g,) = part.groups

    def added(a: list[str], b: list[str], away: int) -> list[str]:
        """SQL of the planes of the sum of counts a at each place i and b at i + away."""
        out, carry = [], None
        for j in range(max(len(a), len(b))):
            given = [f"get({v[j]}, i{f' + {o}' if o else ''})" for v, o in ((a, 0), (b, away)) if j < len(v)] + ([carry] if carry else [])
            out.append(" ^ ".join(given))
            carry = None if len(given) == 1 else f"({given[0]} & {given[1]})" if len(given) == 2 else f"(({given[0]} & {given[1]}) | (({given[0]} ^ {given[1]}) & {given[2]}))"
        return [*out, *([carry] if carry else [])]

    def step(df: DataFrame, own: dict[str, str], size: int, keep: list[str]) -> DataFrame:
        each = [f"transform(if(size(h) >= {size}, sequence(0, size(h) - {size}), cast(array() as array<int>)), i -> {sql}) as {name}" for name, sql in own.items()]
        return df.selectExpr("who", "h", *keep, *each)

    df, one, total, done, size = docs.selectExpr("who", "h", "h as o0_0"), ["o0_0"], [], 0, 1
    for level in range(g.n.bit_length()):
        if g.n >> level & 1:
            sums = added(total, one, done) if total else [f"get({x}, i)" for x in one]
            df = step(df, {f"t{level}_{j}": x for j, x in enumerate(sums)}, done + size, one)
            total, done = [f"t{level}_{j}" for j in range(len(sums))], done + size
        if done < g.n:
            sums = added(one, one, size)
            df = step(df, {f"o{level + 1}_{j}": x for j, x in enumerate(sums)}, 2 * size, total)
            one, size = [f"o{level + 1}_{j}" for j in range(len(sums))], 2 * size
    half = _half([f"get({x}, i)" for x in total], g.n)
    df = step(df, {"fps": half}, g.n, []).selectExpr("who", "h", "posexplode_outer(fps) as (start, fp)").where("start is not null")
    df = df.crossJoin(F.broadcast(part.row(docs.sparkSession))).selectExpr("*", f"{part.met(0)} as met").where(part.near(0))
    df = df.selectExpr("who", "0 as k", "fp", "start", f"slice(h, start + 1, {g.n}) as win", "ix")
    return df.where(f"aggregate(win, 0, (a, x) -> a + {part.known('x')}) >= {_enough(g.n, least)}").drop("ix")


def _parts(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """The items (width, n, item, hashes) in runs of one width and about `most` shingles; one run at a time is on the driver."""
    hold, size = [], 0
    for r in items.orderBy("width", "n").toLocalIterator():
        if hold and (size >= most or len(hold) >= ITEMS or r.width != hold[0].width or r.n > LADDER and r.n != hold[0].n):
            yield hold
            hold, size = [], 0
        hold.append(r)
        size += r.n
    if hold:
        yield hold


def contaminated(docs: DataFrame, items: DataFrame, least: float = 0.8, shingle: int = 5, part: int = PART_SHINGLES) -> DataFrame:
    """doc_id, item_id, similarity, start: for each document and item its best window of at least `least` (first word from 0).

    docs: doc_id, text; items: item_id, text; other columns are ignored. Null, empty and wordless texts match nothing; a document shorter
    than an item can't hold its window. Of equal windows the first counts. Repeated rows of docs, those with a null or repeated doc_id
    included, are each reported; repeated rows of items once. Empty tables give no rows. A text of any length is handled by one task in
    time linear in its words and the number of item sizes.
    """
    kind = lambda df, c: df.schema[c].dataType
    out = T.StructType([T.StructField("doc_id", kind(docs, "doc_id")), T.StructField("item_id", kind(items, "item_id")), T.StructField("similarity", T.DoubleType()), T.StructField("start", T.LongType())])
    spark = docs.sparkSession
    words = docs.selectExpr("struct(monotonically_increasing_id() as rid, doc_id) as who", f"{_words('text')[0][1]} as t").selectExpr("who", f"{_words('text')[1][1]} as w")
    own = items.selectExpr("item_id", f"{_words('text')[0][1]} as t").selectExpr("item_id", f"{_words('text')[1][1]} as w").where("size(w) > 0").distinct()
    own = C.staged(own, "items")
    hashed = None
    for width in range(1, shingle + 1):
        mine = own.where(F.size("w") == width if width < shingle else F.size("w") >= width)
        mine = _stepped(mine, ["item_id", "w"], _sequences(width)).selectExpr(f"{width} as width", "size(h) as n", "item_id", "h")
        hashed = mine if hashed is None else hashed.unionByName(mine)
    hashed = C.staged(hashed, "item-hashes")

    def search(run: list[tuple]) -> DataFrame:
        width = run[0].width
        found = [np.array(r.h, np.int64).view(np.uint64) for r in run]
        by_size: dict[int, list[int]] = {}
        for i, r in enumerate(run):
            by_size.setdefault(r.n, []).append(i)
        groups = [Index._group(width, n, at[a : a + 64], found) for n, at in sorted(by_size.items()) for a in range(0, len(at), 64)]
        bits = max(12, (16 * sum(map(len, found)) - 1).bit_length())
        here = Part(width, groups, bits)
        rows = []
        for k, g in enumerate(groups):
            for i, x in zip(g.at, _signed(g.prints), strict=True):
                each, count = np.unique(found[i], return_counts=True)
                rows.append((k, i, run[i].item_id, x, _signed(each), count.tolist()))
        table = spark.createDataFrame(rows, T.StructType([T.StructField("k", T.IntegerType()), T.StructField("at", T.IntegerType()), out["item_id"], T.StructField("print", T.LongType()), T.StructField("each", T.ArrayType(T.LongType(), False)), T.StructField("count", T.ArrayType(T.IntegerType(), False))]))
        rows = _stepped(words, ["who", "w"], _sequences(width)).select("who", "h")
        if groups[0].n <= LADDER:
            met = _candidates(rows, here, least)
        else:
            met = None
            for g in groups:
                one = _long_candidates(rows, Part(width, [g], bits), least).withColumn("k", F.lit(groups.index(g)))
                met = one if met is None else met.unionByName(one)
        near = met.join(F.broadcast(table), "k").where(f"bit_count(fp ^ print) <= {RADIUS}")
        # shared shingles, each as often as both have it; a window of distinct ones by sets
        shared = "if(size(array_distinct(win)) = size(win), size(array_intersect(win, each)), aggregate(zip_with(each, count, (x, c) -> least(c, size(filter(win, y -> y = x)))), 0, (a, x) -> a + x))"
        near = near.selectExpr("who", "at", "item_id", "start", "size(win) as n", f"{shared} as shared").selectExpr("who", "at", "item_id", "start", "cast(shared as double) / (2 * n - shared) as similarity").where(F.col("similarity") >= least)
        best = near.groupBy("who.rid", "at").agg(F.min(F.struct(-F.col("similarity"), "start", "who", "item_id")).alias("b"))
        return best.selectExpr("b.who.doc_id as doc_id", "b.item_id as item_id", "-b.col1 as similarity", "cast(b.start as bigint) as start")

    found = None
    for run in _parts(hashed, part):
        found = search(run) if found is None else found.unionByName(search(run))
    return found if found is not None else spark.createDataFrame([], out)


def op6_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contaminated(docs, items).select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "start")


ORACLE = r"""
with it as (select distinct item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') as w from benchmark where text is not null),
i1 as (select item_id, w, least(5, len(w)) as k, len(w) - least(5, len(w)) + 1 as n from it where len(w) > 0),
i2 as (select item_id, k, n, unnest(range(1, n + 1)) as q, w from i1),
ish as (select item_id, k, n, q, array_to_string(w[q:q + k - 1], ' ') as s from i2),
d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') as w from documents),
ks as (select distinct k from i1),
d2 as (select doc_id, k, len(w) - k + 1 as m, unnest(range(1, len(w) - k + 2)) as p, w from d, ks where len(w) >= k),
dsh as (select doc_id, k, m, p, array_to_string(w[p:p + k - 1], ' ') as s from d2),
hit as (select distinct doc_id, item_id, dsh.k, n, m, p from dsh join ish on dsh.k = ish.k and dsh.s = ish.s),
st as (select distinct doc_id, item_id, k, n, unnest(range(greatest(p - n + 1, 1), least(p, m - n + 1) + 1)) as a from hit),
wc as (select st.doc_id, st.item_id, st.a, st.n, dsh.s, count(*) as c from st join dsh on dsh.doc_id = st.doc_id and dsh.k = st.k and dsh.p between st.a and st.a + st.n - 1 group by all),
ic as (select item_id, s, count(*) as c from ish group by all),
sh as (select wc.doc_id, wc.item_id, a, any_value(n) as n, sum(least(wc.c, ic.c)) as i from wc join ic on wc.item_id = ic.item_id and wc.s = ic.s group by wc.doc_id, wc.item_id, a),
sim as (select *, i / (2.0 * n - i) as similarity from sh where i / (2.0 * n - i) >= 0.8),
r as (select *, row_number() over (partition by doc_id, item_id order by similarity desc, a) as k from sim)
select doc_id, item_id, round(similarity::double, 6) as similarity, (a - 1)::bigint as start from r where k = 1
"""
