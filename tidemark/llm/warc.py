"""Content-addressed WARC archive.

Payload bytes are stored once for each SHA-256 digest; record headers, exact to the byte, are a table of their own; a record is
rebuilt by a join of the two. Reading parses the rebuilt bytes and verifies the digest of every stored payload.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

#: Equal payloads from this many bytes on have one response; the other records revisit it.
REVISIT_BYTES = 1000
#: Fixed values of WARC 1.1: media types, and the profile of a revisit to an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEADERS = "page_id long, strong string, stored boolean, refers_to long, head binary"


def record_head(page_id: int | None, url: str | None, kind: str, refers_to: int | None, size: int, sha1: bytes, date: str) -> bytes:
    """All of a record before the payload: WARC fields, blank line, HTTP head, blank line."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(sha1).decode())
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (size if kind == 'response' else 0)}"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def parse_record(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record; raises ValueError if its lengths don't fit."""
    head, found, block = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not found or not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    length = int(fields["content-length"])
    if block[length:] != b"\r\n\r\n":
        raise ValueError("a record ends with two line ends after its block")
    http, _, payload = block[:length].partition(b"\r\n\r\n")
    return fields, {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode().split("\r\n")[1:])}, payload


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write path/headers and path/payloads for pages (page_id, url, html).

    Null html counts as empty, and a null url leaves its field out. Of equal payloads of REVISIT_BYTES or more, the row with
    the largest page_id is the response; rows that repeat this page_id and payload are responses too. A null page_id is never the one
    revisited if another row has an id; alone, it is a response. Only digests are grouped; payloads move once, to be stored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("strong", F.sha2("payload", 256))
    light = C.staged(rows.select("page_id", "url", "strong", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1")), "warc-rows")
    owners = C.staged(light.groupBy("strong").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("__n")), "warc-owners")
    kinds = C.hot_join(light, owners, ["strong"]).withColumn("revisit", (F.col("size") >= REVISIT_BYTES) & F.coalesce(F.col("page_id") != F.col("owner"), F.col("page_id").isNull() & F.col("owner").isNotNull()))

    def heads(batches):
        for batch in batches:
            got = batch.to_pydict()
            out = [record_head(p, u, "revisit" if r else "response", o, n, bytes.fromhex(d), date) for p, u, r, o, n, d in zip(*(got[c] for c in ("page_id", "url", "revisit", "owner", "size", "sha1")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("strong"), pa.array([not r for r in got["revisit"]]), pa.array([o if r else None for r, o in zip(got["revisit"], got["owner"], strict=True)], pa.int64()), pa.array(out, pa.binary())], ["page_id", "strong", "stored", "refers_to", "head"])

    kinds.mapInArrow(heads, _HEADERS).write.parquet(f"{path}/headers")
    # rows of one digest hold equal bytes, so any of them is stored; copies met in one task are combined before the shuffle
    rows.select("strong", "payload").dropDuplicates(["strong"]).write.parquet(f"{path}/payloads")


def read_records(spark, path: str) -> DataFrame:
    """page_id, strong, refers_to, record: each record's bytes, rebuilt. A missing payload raises an error when it is read.

    Small payloads that very many records hold are joined by broadcast: HOT_KEYS of them at most, each under REVISIT_BYTES.
    """
    heads = spark.read.schema(_HEADERS).parquet(f"{path}/headers")
    payloads = spark.read.schema("strong string, payload binary").parquet(f"{path}/payloads")
    end = F.lit(bytearray(b"\r\n\r\n"))
    stored = heads.where("stored")
    counts = C.staged(stored.groupBy("strong").agg(F.count(F.lit(1)).alias("n")), "warc-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > max(C.HOT_ROWS, total // C.HOT_KEYS)).select("strong")
    few = None
    if not hot.isEmpty():
        few = C.staged(payloads.join(F.broadcast(hot), "strong", "left_semi").where(F.octet_length("payload") < REVISIT_BYTES), "warc-hot")
    rest = stored if few is None else stored.join(F.broadcast(few.select("strong")), "strong", "left_anti")
    full = rest.join(payloads, "strong", "left").withColumn("payload", F.when(F.col("payload").isNull(), F.raise_error(F.concat(F.lit("no payload "), F.col("strong"))).cast("binary")).otherwise(F.col("payload")))
    if few is not None:
        full = full.unionByName(stored.join(F.broadcast(few), "strong"))
    whole = full.select("page_id", "strong", "refers_to", F.concat("head", "payload", end).alias("record"))
    return whole.unionByName(heads.where("not stored").select("page_id", "strong", "refers_to", F.concat("head", end).alias("record")))


def verify_revisits(spark, path: str) -> None:
    """Raises ValueError if a revisit refers to a page that has no stored record of the same digest."""
    heads = spark.read.schema(_HEADERS).parquet(f"{path}/headers")
    asked = heads.where("not stored").groupBy("strong", "refers_to").agg(F.count(F.lit(1)).alias("n"))
    held = heads.where("stored").select("strong", F.col("page_id").alias("refers_to")).distinct()
    lost = asked.join(held, ["strong", "refers_to"], "left_anti").agg(F.sum("n"), F.min("strong")).first()
    if lost[0]:
        raise ValueError(f"{lost[0]} revisits refer to no stored record, among them one of digest {lost[1]}")


def read_back(spark, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, parsed from the rebuilt records.

    Digests and lengths of stored payloads are verified, and that revisits refer to a stored record of the same digest; else an error is raised.
    """
    verify_revisits(spark, path)
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def run(batches):
        for batch in batches:
            rows = []
            for page, strong, owner, record in zip(*(batch.column(c).to_pylist() for c in ("page_id", "strong", "refers_to", "record")), strict=True):
                fields, http, payload = parse_record(record)
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
                back = int(fields["warc-refers-to"].removeprefix("<urn:page:").removesuffix(">")) if fields["warc-type"] == "revisit" else None
                if back != owner:
                    raise ValueError(f"record of page {page} refers to {back}, not to {owner}")
                if back is None and (hashlib.sha256(payload).hexdigest() != strong or hashlib.sha1(payload).digest() != digest or len(payload) != int(http["content-length"])):
                    raise ValueError(f"payload of page {page} doesn't have its digest")
                rows.append((page, int(http["content-length"]), digest.hex(), fields["warc-type"], back))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return read_records(spark, path).mapInArrow(run, schema)


def op8_warc(pages: DataFrame) -> DataFrame:
    path = C.fresh_dir(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_back(pages.sparkSession, path)


ORACLE = """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, ''))::bigint as n, sha1(coalesce(html, '')) as d from pages),
m as (select *, max(page_id) over (partition by html) as last from p)
select page_id, n as payload_bytes, d as payload_digest, case when n >= 1000 and page_id <> last then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id <> last then last end as refers_to from m
"""
