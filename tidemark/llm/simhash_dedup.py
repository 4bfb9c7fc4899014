"""SimHash near-dedup by pigeonhole blocks.

A fingerprint of 64 bits is split into `distance` + 2 blocks; two that differ in at most `distance` bits agree in at least
two of them, so each fingerprint is keyed by every pair of blocks. Fingerprints that share a key are joined and the
Hamming distance is verified. A key held by over BUCKET distinct fingerprints isn't paired out: its members share all but
the other blocks' bits, and are linked through their variants with one bit flipped: two within two bits have such a variant
in common, and those that meet in one are linked to the least of them, after verification.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C
from tidemark.llm.components import components

#: Distinct fingerprints of a key that are still compared pairwise.
BUCKET = 64


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash over word shingles of a text in lower case (A-Z); no words give zero."""
    words = text.lower().split()  # bytes: only A-Z and only the six space characters
    if not words:
        return 0
    joined = b" ".join(words)
    take = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - take + 1].tolist(), ends[take - 1 :].tolist(), strict=True)], np.uint64)
    total = np.zeros(64, np.int64)
    for a in range(0, len(h), 1 << 16):
        total += np.unpackbits(h[a : a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """docs with fp, a signed long that holds the 64 bits. Null text counts as empty."""
    out = T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(text).to_pylist()
            fp = np.array([fingerprint((t or "").encode(), shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp, pa.int64())], [*batch.schema.names, "fp"])

    return docs.mapInArrow(run, out)


def _blocks(count: int) -> list[int]:
    """Masks of blocks that split 64 bits."""
    cuts = [round(64 * i / count) for i in range(count + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (u, v) among distinct fingerprints (fp) that connect all pairs within `distance` bits; each edge is such a pair."""
    masks = [_signed(a | b) for a, b in combinations(_blocks(distance + 2), 2)]
    keyed = fps.select("fp", F.inline(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])))
    sizes = C.staged(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "buckets")
    within = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance
    small = keyed.join(sizes.where(F.col("c") <= BUCKET).select("t", "key"), ["t", "key"])
    pairs = small.alias("a").join(small.alias("b"), ["t", "key"]).where("a.fp < b.fp").select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).where(within("u", "v"))
    crowded = C.staged(keyed.join(sizes.where(F.col("c") > BUCKET).select("t", "key"), ["t", "key"], "left_semi").select("fp").distinct(), "crowded")
    if not 1 <= distance <= 2:
        raise ValueError("variants have one flipped bit, so the distance is 1 or 2")
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    variants = crowded.select("fp", F.explode(flips).alias("v"))
    least = variants.groupBy("v").agg(F.min("fp").alias("u"), F.count(F.lit(1)).alias("c")).where("c > 1").select("v", "u")
    stars = variants.withColumnRenamed("fp", "w").join(least, "v").where("u <> w").select("u", F.col("w").alias("v")).where(within("u", "v"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, distance: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the least doc_id reached over fingerprints within `distance` bits.

    Null and wordless texts have fingerprint zero and are linked like any other. Equal fingerprints are one node, held
    by its least doc_id, so groups of copies cost one row. Rows that repeat a doc_id are all returned, each with the
    fingerprint of its text, but are one document: they belong to one component. A null doc_id is returned with its
    fingerprint and, if others share the component, their least id. An empty table gives no rows.
    """
    rows = C.staged(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "text", shingle).select("doc_id", "fp"), "fingerprints")
    nodes = C.staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("__n")), "nodes")
    repeated = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("u"), F.max("fp").alias("m")).where("u <> m")
    same = rows.join(repeated, "doc_id").select("u", F.col("fp").alias("v")).where("u <> v")
    found = C.staged(components(links(nodes.select("fp"), distance).unionByName(same)), "components")
    least = C.staged(found.join(nodes, found["node"] == nodes["fp"]).groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("__n")), "roots")
    classes = C.hot_join(found, least, ["root"]).select(F.col("node").alias("fp"), "component_id")
    classes = C.staged(nodes.join(classes, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"), "__n"), "classes")
    out = rows.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"))
    return C.hot_join(out, classes, ["fp"]).select("doc_id", "fingerprint", "component_id")


def op3_simhash_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
