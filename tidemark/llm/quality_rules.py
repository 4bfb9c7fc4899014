"""Quality rules: text statistics, and cross-document line frequency by host. DataFrame functions only.

Normalised lines (lower case, single spaces) are hashed; for each host the distinct documents that hold a line are counted, each row being
a document. Lines above the limit are removed; a document left with too few of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

#: Frequent lines, over all hosts, up to which they are broadcast; beyond it lines are joined to them on (host, line) by a shuffle.
BROADCAST_LINES = 1_000_000
#: Parts that the rows of one text and host are dealt to where they are joined to its line numbers.
SALTS = 16

SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words of a text, in order; null gives none."""
    text = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def normalised(line: Column) -> Column:
    return F.lower(F.array_join(words_of(line), " "))


def _statistics(text: Column) -> Column:
    """Struct of a text's statistics. Each step is bound to a lambda's variable: an optimiser that copies expressions can't repeat it."""
    none = F.array().cast("array<bigint>")

    def covered(places):
        """Words in the union of 8-word windows at sorted places."""
        gaps = F.transform(places, lambda p, k: F.least(F.lit(8), F.coalesce(F.get(places, k + 1) - p, F.lit(8))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def met(pairs):
        """Places of windows whose hash equals a neighbour's in the sorted list."""
        h = lambda i: F.get(pairs, i)["h"]
        return F.array_sort(F.array_compact(F.transform(pairs, lambda p, i: F.when((h(i - 1) == p["h"]) | (h(i + 1) == p["h"]), p["i"]))))

    def repeated(hashes):
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), C.let(C.let(pairs, met), covered)).otherwise(F.lit(0))

    def of(w):
        n = F.size(w)
        windows = F.when(n >= 8, F.transform(F.sequence(F.lit(1), F.greatest(n - 7, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, 8)))).otherwise(none)
        return F.struct(n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), C.let(windows, repeated).cast("long").alias("n_repeat_words"))

    return C.let(words_of(text), of)


def text_statistics(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text. The first, second and last are fields of one struct: bind it first."""
    whole = F.coalesce(text, F.lit(""))
    symbols = sum((F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit(s), F.lit(""))) for s in SYMBOLS), F.lit(0))
    lines = F.filter(lines_of(text), lambda x: x.rlike(C.WORD_PATTERN))
    doubled = C.let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return {"statistics": _statistics(text), "n_symbols": symbols.cast("long"), "n_dup_lines": doubled.cast("long")}


def line_hashes(text: Column) -> Column:
    """Hashes of a text's normalised lines in order; null for lines without a word."""
    return F.transform(F.transform(lines_of(text), normalised), lambda x: F.when(x != "", F.xxhash64(x)))


def _host_key(host: Column) -> Column:
    """A host as text that is never null."""
    return F.coalesce(F.concat(F.lit("h"), host.cast("string")), F.lit("n"))


def frequent_lines(docs: DataFrame, min_docs: int, share: float) -> DataFrame:
    """host, line (hash), __n: lines in over max(min_docs, share of the host's documents) documents of a host. docs: host, text."""
    held = docs.select("host", F.explode(F.array_compact(F.array_distinct(line_hashes(F.col("text"))))).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("__n"))
    total = docs.groupBy("host").agg(F.count(F.lit(1)).alias("all"))
    # over 1/share lines for each line of a mean document can't pass the limit, so a host's list is short
    return held.where(F.col("__n") > min_docs).join(total, "host").where(F.col("__n") > share * F.col("all")).select("host", "line", "__n")


def _marked(rows: DataFrame, common: DataFrame, text: Column) -> DataFrame:
    """rows with __gone, the numbers of the lines that are common in their host (null: none): by a broadcast of each host's list if it is
    small enough, else by joins on (host, line) and on (text, host), the latter salted for texts of many copies."""
    host = _host_key(F.col("host"))
    if common.count() <= BROADCAST_LINES:
        lists = F.broadcast(common.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("__list")))
        hit = lambda x: F.coalesce(F.array_contains(F.col("__list"), x), F.lit(False))
        numbered = F.transform(line_hashes(text), lambda x, i: F.when(hit(x), i))
        return rows.join(lists, "host", "left").withColumn("__gone", F.when(F.col("__list").isNotNull(), F.array_compact(numbered))).drop("__list")
    one = rows.select("host", *C.text_key(text), line_hashes(text).alias("lines")).dropDuplicates(["host", "c1", "c2"])
    lines = C.staged(one.select("host", "c1", "c2", F.posexplode("lines").alias("no", "line")).where("line is not null"), "host-lines")
    gone = C.hot_join(lines, common, ["host", "line"]).groupBy("host", "c1", "c2").agg(F.collect_list("no").alias("__gone"))
    gone = gone.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumns({"c1": C.text_key(text)[0], "c2": C.text_key(text)[1], "salt": F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")})
    return salted.join(gone, ["host", "c1", "c2", "salt"], "left").drop("c1", "c2", "salt")


def quality_rules(docs: DataFrame, host: str = "source", min_docs: int = 50, share: float = 0.1, least_kept: float = 0.2) -> DataFrame:
    """docs with text statistics, base_failed, n_common_words (words in removed lines), clean_text (text without them) and kept.

    A document fails the base rule with under 20 words, or with over 30 % of its words in repeated 8-word windows. It is
    depleted if under `least_kept` of its words are left once lines in over max(min_docs, share of the host's documents)
    documents of its host are removed. Null text counts as empty: it has no words and fails. A null host is a host of
    its own. Each row is a document, rows that repeat another or its doc_id included; doc_id isn't used. Other columns stay, whatever
    their names, but those of docs that are named like a new one are replaced. An empty table gives no rows.
    """
    rows = C.packed_row(docs).withColumn("host", _host_key(F.col("row").getField(host)))
    text = F.col("row.text")
    common = C.staged(frequent_lines(rows.select("host", text.alias("text")), min_docs, share), "common-lines")
    out = _marked(rows.withColumns(text_statistics(text)), common, text)
    lines, gone = lines_of(text), F.col("__gone")
    words = F.when(gone.isNull(), F.lit(0)).otherwise(F.aggregate(F.transform(gone, lambda i: F.size(words_of(F.get(lines, i)))), F.lit(0), lambda a, x: a + x)).cast("long")
    clean = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")
    out = out.withColumn("__common", words)
    n = F.col("statistics.n_words")
    failed = (n < 20) | (100 * F.col("statistics.n_repeat_words") > 30 * n)
    return C.unpacked_row(
        out, docs.columns,
        n_words=n, word_chars=F.col("statistics.word_chars"), n_symbols=F.col("n_symbols"), n_dup_lines=F.col("n_dup_lines"), n_repeat_words=F.col("statistics.n_repeat_words"),
        n_common_words=F.col("__common"), clean_text=F.when(gone.isNull() | (F.size(gone) == 0) | text.isNull(), text).otherwise(clean),
        base_failed=failed, kept=~failed & (n - F.col("__common") >= least_kept * n),
    )


def op10_quality_rules(docs: DataFrame) -> DataFrame:
    return quality_rules(docs.select("doc_id", "text", "source")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_common_words")


ORACLE = r"""
with d as (select doc_id, coalesce(text, '') as text, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, unnest(range(1, len(w) - 6)) as i, w from d where len(w) >= 8),
met as (select doc_id, i, count(*) over (partition by doc_id, array_to_string(w[i:i+7], ' ')) as c from win),
cov as (select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + 8)) as k from met where c >= 2) group by doc_id),
l as (select doc_id, source, unnest(string_split(text, chr(10))) as line from d),
n as (select *, lower(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' ')) as norm, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as k from l),
dup as (select doc_id, count(*) - count(distinct line) as n from n where k > 0 group by doc_id),
freq as (select source, norm, count(distinct doc_id) as c from n where k > 0 group by source, norm),
hosts as (select source, count(*) as c from d group by source),
common as (select f.source, f.norm from freq f join hosts h on f.source is not distinct from h.source where f.c > 50 and f.c > 0.1 * h.c),
gone as (select n.doc_id, sum(n.k) as n from n join common c on n.norm = c.norm and n.source is not distinct from c.source group by n.doc_id),
s as (select d.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
  coalesce(dup.n, 0) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words, coalesce(gone.n, 0) as n_common_words
  from d left join dup using (doc_id) left join cov using (doc_id) left join gone using (doc_id))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and n_words - n_common_words >= 0.2 * n_words as kept, n_common_words::bigint as n_common_words
from s
"""
