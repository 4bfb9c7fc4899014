"""Secret scan with a trigram inverted index. DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived. The index is a table of postings (trigram, text), of the trigrams
that the queries name; a text is told by 128 bits, so that copies are one entry. The postings of a text's trigrams meet in a sum of bits,
on which the queries' intersections and unions are computed: that gives each rule's candidates. Rules are verified over their candidates; a
rule without a mandatory trigram (hex runs) scans all texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.trigrams import trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    """kind; pattern; group whose length must be at least `least` for a match to count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base rules of the contract, in their order. Runs of one class are asked for at full length at once.
BASE = (
    Rule("assign", "(" + "|".join(map(any_case, ("password", "passwd", "secret", "token"))) + "|" + any_case("api") + "_?" + any_case("key") + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)
#: Rules the scan adds: public token formats.
ADDED = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", "AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{4,}"),
    Rule("payment", "sk_live_[0-9a-zA-Z]{16,}"),
)


#: Candidates up to which they are broadcast; beyond it they are joined by a shuffle, a text's rows being dealt to SALTS parts.
BROADCAST_ROWS = 1_000_000
SALTS = 16


class TrigramIndex:
    """Postings of the trigrams of some rules' queries, and the rules' candidates."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.queries = {r.kind: trigram_query(r.pattern) for r in rules}
        self.terms = sorted(set().union(*map(trigrams_of, self.queries.values())))

    def postings(self, docs: DataFrame, text: Column) -> DataFrame:
        """term (its number), c1, c2: each trigram of the queries with each text that holds it in any case."""
        low = docs.select(*C.text_key(text), F.lower(text).alias("low"))
        held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(self.terms)]))
        return low.select(F.explode(held).alias("term"), "c1", "c2").distinct()

    def candidates(self, postings: DataFrame) -> DataFrame:
        """c1, c2, rules: for each text that satisfies a query that can be missed the bits of the rules, in their order."""
        bits = lambda k: F.bit_or(F.when((F.col("term") >= k) & (F.col("term") < k + 62), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("term") - k)).otherwise(F.lit(0).cast("long")))
        met = postings.groupBy("c1", "c2").agg(*[bits(k).alias(f"t{k // 62}") for k in range(0, len(self.terms), 62)])
        named = [(i, q) for i, q in enumerate(self.queries.values()) if q is not True]
        mask = sum((F.when(self.holds(q), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, q in named), F.lit(0).cast("long"))
        return met.select("c1", "c2", mask.alias("rules")).where("rules <> 0")

    def holds(self, query: object) -> Column:
        """Whether a text's trigrams satisfy a query."""
        if isinstance(query, str):
            query = ("and", [query])
        kind, parts = query
        if kind == "or":
            found = F.lit(False)
            for q in parts:
                found = found | self.holds(q)
            return found
        masks: dict[int, int] = {}
        found = F.lit(True)
        for q in parts:
            if isinstance(q, str):
                i = self.terms.index(q)
                masks[i // 62] = masks.get(i // 62, 0) | 1 << i % 62
            else:
                found = found & self.holds(q)
        for k, m in masks.items():
            found = found & (F.col(f"t{k}").bitwiseAND(F.lit(m)) == m)
        return found


def _spans(matches: Column, groups: Column, pieces: Column, rule: Rule, order: int) -> Column:
    """Places of matches from the lengths of what lies between them."""
    kind = "array<struct<start:int,kind:int,name:string,end:int>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def step(acc, i):
        start = acc["at"] + F.length(F.get(pieces, i))
        end = start + F.length(F.get(matches, i))
        one = F.array(F.struct(start.alias("start"), F.lit(order).alias("kind"), F.lit(rule.kind).alias("name"), end.alias("end"))).cast(kind)
        return F.struct(end.alias("at"), F.when(F.length(F.get(groups, i)) >= rule.least, F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found"))

    return F.when(F.size(matches) > 0, F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), begin, step, lambda acc: acc["found"])).otherwise(F.array().cast(kind))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, text: str = "text") -> DataFrame:
    """docs with spans: array of (start, kind, name, end) in code points, by start, then rule order.

    Matches of one rule are leftmost and don't overlap; a match too short takes its place but isn't reported. Null text counts as
    empty and has no span; repeated rows and null ids are rows like any others. Other columns stay, whatever their names, but a column
    `spans` of docs is replaced. An empty table gives no rows. At most 62 rules.
    """
    index = TrigramIndex(rules)
    rows = C.packed_row(docs)
    body = F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))
    found = C.staged(index.candidates(C.staged(index.postings(rows, body), "postings")), "candidates") if index.terms else None
    out = rows.withColumn("body", body)
    if found is not None:
        out = out.withColumns(dict(zip(("c1", "c2"), C.text_key(F.col("body")), strict=True)))
        if found.count() <= BROADCAST_ROWS:
            out = out.join(F.broadcast(found), ["c1", "c2"], "left")
        else:
            found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            out = out.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(found, ["c1", "c2", "salt"], "left")
    asked = {r.kind: F.lit(True) if index.queries[r.kind] is True else F.coalesce(F.col("rules").bitwiseAND(F.lit(1 << i)) != 0, F.lit(False)) for i, r in enumerate(rules)}
    # regexp_extract_all and split walk the text alike, so pieces and matches alternate
    out = out.withColumns({f"m{i}": F.when(asked[r.kind], F.regexp_extract_all("body", F.lit(r.pattern), F.lit(0))) for i, r in enumerate(rules)})
    more = {}
    for i, r in enumerate(rules):
        some = F.size(F.col(f"m{i}")) > 0
        more[f"p{i}"] = F.when(some, F.split("body", r.pattern, -1))
        if r.group:
            more[f"g{i}"] = F.when(some, F.regexp_extract_all("body", F.lit(r.pattern), F.lit(r.group)))
    out = out.withColumns(more)
    spans = [_spans(F.col(f"m{i}"), F.col(f"g{i}" if r.group else f"m{i}"), F.col(f"p{i}"), r, i) for i, r in enumerate(rules)]
    return C.unpacked_row(out, docs.columns, spans=F.array_sort(F.concat(*spans)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op4_secret_scan(docs: DataFrame) -> DataFrame:
    found = scan_secrets(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_joined(F.filter("spans", lambda s: s["kind"] < len(BASE))), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def oracle(rules: tuple[Rule, ...] = BASE + ADDED) -> str:
    """DuckDB SQL: places by pieces and matches of each rule over all documents, without an index."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(rules):
        parts.append(f"""select doc_id, {i} as kind, '{r.kind}' as name, list_transform(range(1, len(m) + 1), lambda k: {{
          's': list_sum(list_transform(p[1:k], lambda x: length(x)))::bigint + coalesce(list_sum(list_transform(m[1:k-1], lambda x: length(x))), 0)::bigint, 'n': length(m[k]), 'g': length(g[k])}}) as found
        from (select doc_id, regexp_extract_all(text, {quoted(r.pattern)}, 0) as m, regexp_extract_all(text, {quoted(r.pattern)}, {r.group}) as g, string_split_regex(text, {quoted(r.pattern)}) as p from d)""")
    return f"""with d as (select doc_id, coalesce(text, '') as text from documents), a as ({" union all ".join(parts)}),
    s as (select doc_id, kind, name, f.s as s, f.s + f.n as e from (select doc_id, kind, name, unnest(found) as f from a), (select unnest([{", ".join(str(r.least) for r in rules)}]) as least, unnest(range({len(rules)})) as rk) where rk = kind and f.g >= least)
    select d.doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
      sha256(coalesce(string_agg(name || ':' || s || ':' || e, ',' order by s, kind) filter (kind < 3), '')) as base_sha256,
      coalesce(string_agg(name || ':' || s || ':' || e, ',' order by s, kind), '') as spans
    from d left join s on d.doc_id = s.doc_id group by d.doc_id"""
