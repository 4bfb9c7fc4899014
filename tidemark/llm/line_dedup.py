"""Line dedup by a deletion-neighbourhood join. DataFrame functions only.

A line is the sequence of its words. Two lines are duplicates if their words are equal or within one edit, an inserted, deleted or replaced
unit. The units of a line of `min_fuzzy_words` words or more are its words; those of a shorter line of `min_fuzzy_chars` characters or more,
its words joined by one space, are the characters. So an edit is an eighth of a line at most. Lines of different units and still shorter ones
must be equal.

Equal lines are first brought down to their earliest place. If two lines are within one edit, half of their units, at the
front or the back, are equal; only lines that share such a half with another emit all variants with one unit deleted, as
hashed keys. A key is the exclusive or of a hash of each unit with its place, so that running sums over a line's units give all
its variants in time linear in them; lines of up to DIRECT characters hash each variant's text instead. Two lines of equal length that meet
in a key of the same place may differ in that unit, and two whose lengths differ by one meet as a whole line and a variant. Each is paired with the earliest line of its key alone, so no pairs of
a group arise; the pair's edit distance is then verified on the units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.quality_rules import lines_of, words_of

#: Rows of two or three numbers up to which a table is broadcast; beyond it the join is a shuffle.
BROADCAST_ROWS = 1_000_000
#: Characters up to which the variants of a line of characters are hashed one by one. One more is keyed both ways, so that lines one apart always meet.
DIRECT = 256


def _bounded(df: DataFrame) -> DataFrame:
    """df, a staged table, marked for broadcast if its count allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _place() -> Column:
    return F.struct(F.col("__doc").alias("doc"), F.col("__line").alias("line"))


def _halves(n: Column, front, back, kind: int) -> Column:
    """Hashes of the front and back halves of a line of n units; lines one unit apart share the shorter one's half length."""
    half = (n / 2).cast("int")

    def keys(t):
        return [F.xxhash64(F.lit(kind), t, front(t)), F.xxhash64(F.lit(kind + 1), t, back(t))]

    return F.array_distinct(F.when(n % 2 == 0, F.array(*keys(half), *keys(half - 1))).otherwise(F.array(*keys(half))))


def line_keys(docs: DataFrame, min_fuzzy_words: int, min_fuzzy_chars: int) -> DataFrame:
    """One row for each line with a word: its place, a 128-bit key of its words, and the half keys."""
    lines = docs.select(F.col("doc_id").alias("__doc"), F.posexplode_outer(lines_of(F.col("text"))).alias("__line", "__text"))
    lines = lines.where(F.col("__text").rlike("[^\\x20\\x09-\\x0D]")).withColumn("__w", words_of(F.col("__text")))
    w = F.col("__w")
    n = F.size(w)
    by_word = _halves(n, lambda t: F.slice(w, F.lit(1), t), lambda t: F.slice(w, n - t + 1, t), 1)

    def by_char(x):
        return C.let(F.length(x), lambda m: F.when(m >= min_fuzzy_chars, _halves(m, lambda t: F.substr(x, F.lit(1), t), lambda t: F.substr(x, m - t + 1, t), 3)))

    halves = F.when(n >= min_fuzzy_words, by_word).otherwise(C.let(F.array_join(w, " "), by_char))  # bound: inlined, it took ten times as long
    return lines.select("__doc", "__line", F.xxhash64("__w").alias("__k1"), F.xxhash64(F.lit("b"), F.reverse("__w")).alias("__k2"), halves.alias("__halves"))


def variants(words: DataFrame) -> DataFrame:
    """For lines (__k1, __k2, __doc, __line, __n, __w: hashes of their units, __norm: the text of a line of characters): key __v of the whole
    line (__del -1) and of it without each unit (__del its place)."""
    norm, i = F.col("__norm"), F.col("__del")
    short = words.where(norm.isNotNull() & (F.col("__n") <= DIRECT + 1))
    short = short.select("__k1", "__k2", "__doc", "__line", "__n", "__norm", F.explode(F.sequence(F.lit(-1), F.col("__n") - 1)).alias("__del"))
    cut = F.when(i < 0, norm).otherwise(F.concat(F.substr(norm, F.lit(1), i), F.substr(norm, i + 2, F.col("__n"))))
    return _running(words.where(norm.isNull() | (F.col("__n") > DIRECT))).unionByName(short.select("__k1", "__k2", "__doc", "__line", "__n", "__del", F.xxhash64(cut).alias("__v")))


def _running(words: DataFrame) -> DataFrame:
    """The variants by running sums."""
    tokens = words.repartition("__k1", "__k2").select("__k1", "__k2", "__doc", "__line", "__n", F.posexplode("__w").alias("__i", "__h"))
    tokens = tokens.withColumns({"__a": F.xxhash64("__h", "__i"), "__b": F.xxhash64("__h", F.col("__i") - 1)})
    line = Window.partitionBy("__k1", "__k2")
    upto = line.orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
    sums = tokens.withColumns({"__ra": F.bit_xor("__a").over(upto), "__rb": F.bit_xor("__b").over(upto), "__ta": F.bit_xor("__a").over(line), "__tb": F.bit_xor("__b").over(line)})
    without = F.col("__ra").bitwiseXOR(F.col("__a")).bitwiseXOR(F.col("__tb")).bitwiseXOR(F.col("__rb"))  # units before as they are, those after one place down
    one = F.struct(F.col("__i").alias("__del"), without.alias("__v"))
    whole = F.struct(F.lit(-1).alias("__del"), F.col("__ta").alias("__v"))
    return sums.select("__k1", "__k2", "__doc", "__line", "__n", F.inline(F.when(F.col("__i") == 0, F.array(whole, one)).otherwise(F.array(one))))


def _without(w: Column, i: Column) -> Column:
    return F.concat(F.slice(w, F.lit(1), i), F.slice(w, i + 2, F.size(w)))


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Of pairs (__k1, __k2 and l1, l2: two lines; long1: whether the first has one unit more, long2: whether the second; del: the place) those within one edit."""
    pairs = C.staged(pairs.distinct(), "line-pairs")
    held = words.select("__k1", "__k2", "__w")
    asked = pairs.groupBy("l1", "l2").agg(F.count(F.lit(1)).alias("__n"))
    other = C.staged(asked.join(held.select(F.col("__k1").alias("l1"), F.col("__k2").alias("l2"), F.col("__w").alias("o")), ["l1", "l2"]), "line-others")
    both = C.hot_join(pairs, other, ["l1", "l2"]).join(held, ["__k1", "__k2"])
    w, o, i = F.col("__w"), F.col("o"), F.col("del")
    return both.where(F.when(F.col("long1"), _without(w, i) == o).when(F.col("long2"), _without(o, i) == w).otherwise((F.size(w) == F.size(o)) & (_without(w, i) == _without(o, i))))


def near_lines(docs: DataFrame, lines: DataFrame, held: DataFrame, min_fuzzy_words: int) -> DataFrame:
    """Keys of the lines within one edit of an earlier one."""
    key = ["__k1", "__k2"]
    # lines that share a half with another line
    halves = lines.where("__halves is not null").select("__k1", F.explode("__halves").alias("__half"))
    shared = halves.groupBy("__half").agg(F.min("__k1").alias("a"), F.max("__k1").alias("b")).where("a < b").select("__half")
    shared = _bounded(C.staged(shared, "shared-halves"))
    near = lines.where("__halves is not null").select(*key, F.explode("__halves").alias("__half")).join(shared, "__half", "left_semi").select(*key).distinct()
    near = C.staged(near.join(held, key).select(*key, F.col("__first.doc").alias("__doc"), F.col("__first.line").alias("__line")), "near-lines")

    # their words again, from the earliest place of each; rows that repeat a doc_id may differ there
    places = _bounded(near)
    if places is not near:  # texts without such a line needn't be split again
        docs = docs.join(F.broadcast(near.select(F.col("__doc").alias("doc_id")).distinct()), "doc_id", "left_semi")
    text = docs.select(F.col("doc_id").alias("__doc"), F.posexplode_outer(lines_of(F.col("text"))).alias("__line", "__text"))
    words = text.join(places, ["__doc", "__line"]).select("__doc", "__line", *key, words_of(F.col("__text")).alias("__w"))
    words = words.where((F.xxhash64("__w") == F.col("__k1")) & (F.xxhash64(F.lit("b"), F.reverse("__w")) == F.col("__k2")))
    words = words.withColumn("__norm", F.when(F.size("__w") < min_fuzzy_words, F.array_join("__w", " ")))
    units = F.when(F.col("__norm").isNull(), F.transform("__w", lambda w: F.xxhash64(w))).otherwise(F.transform(F.split("__norm", ""), lambda x: F.xxhash64(F.lit("c"), x)))
    words = words.select("__doc", "__line", *key, "__norm", units.alias("__w")).withColumn("__n", F.size("__w"))
    words = C.staged(words.distinct(), "near-words")

    every = C.staged(variants(words), "variants")
    met = every.groupBy("__v").agg(F.min("__k1").alias("a"), F.max("__k1").alias("b")).where("a < b").select("__v")
    met = C.staged(every.join(_bounded(C.staged(met, "met-variants")), "__v", "left_semi"), "met-lines")
    C.unstage(every)

    # one unit replaced: equal length and place
    least = F.struct("__doc", "__line", F.col("__k1").alias("l1"), F.col("__k2").alias("l2"))
    replaced = met.where("__del >= 0").groupBy("__v", "__n", "__del").agg(F.min(least).alias("x"), F.count(F.lit(1)).alias("c")).where("c > 1").select("__v", "__n", "__del", "x", F.col("c").alias("__c"))
    late = C.hot_join(met, C.staged(replaced, "replaced"), ["__v", "__n", "__del"], count="__c").where(_place() > F.struct("x.__doc", "x.__line"))
    pairs = late.select(*key, "x.l1", "x.l2", F.lit(False).alias("long1"), F.lit(False).alias("long2"), F.col("__del").alias("del"))
    # one unit inserted: a whole line and a variant of one unit more; the later of the two goes
    longer = met.where("__del >= 0").withColumn("__n", F.col("__n") - 1)
    whole = met.where("__del = -1").groupBy("__v", "__n").agg(F.min(least).alias("x"))
    whole = C.staged(whole.join(longer.groupBy("__v", "__n").agg(F.count(F.lit(1)).alias("__c")), ["__v", "__n"]), "wholes")
    both = C.hot_join(longer, whole, ["__v", "__n"], count="__c").withColumn("first", _place() > F.struct("x.__doc", "x.__line"))
    one, two = F.struct(*key), F.struct(F.col("x.l1").alias("__k1"), F.col("x.l2").alias("__k2"))
    both = both.select(F.when(F.col("first"), one).otherwise(two).alias("a"), F.when(F.col("first"), two).otherwise(one).alias("b"), "first", F.col("__del").alias("del"))
    inserted = both.select(F.col("a.__k1").alias("__k1"), F.col("a.__k2").alias("__k2"), F.col("b.__k1").alias("l1"), F.col("b.__k2").alias("l2"), F.col("first").alias("long1"), (~F.col("first")).alias("long2"), "del")
    return verified(pairs.unionByName(inserted), words).select(*key).distinct()


def duplicate_lines(docs: DataFrame, min_fuzzy_words: int = 8, min_fuzzy_chars: int = 8) -> DataFrame:
    """Places of the lines that go: __doc, __gone (line numbers from 0)."""
    lines = C.staged(line_keys(docs, min_fuzzy_words, min_fuzzy_chars), "line-keys")
    key = ["__k1", "__k2"]
    held = C.staged(lines.groupBy(*key).agg(F.min(_place()).alias("__first"), F.count(F.lit(1)).alias("__c")), "distinct-lines")
    fuzzy = near_lines(docs, lines, held, min_fuzzy_words).withColumn("__fuzzy", F.lit(True))
    marks = held.join(fuzzy, key, "left").where("__c > 1 or __fuzzy").select(*key, "__first", F.coalesce("__fuzzy", F.lit(False)).alias("__fuzzy"), "__c")
    marks = C.staged(marks, "line-marks")
    found = lines.join(F.broadcast(marks), key) if marks.count() <= BROADCAST_ROWS else C.hot_join(lines, marks, key, count="__c")
    gone = found.where(F.col("__fuzzy") | (_place() > F.col("__first")))
    return gone.groupBy("__doc").agg(F.sort_array(F.collect_set("__line")).alias("__gone"))


def dedup_lines(docs: DataFrame, min_fuzzy_words: int = 8, min_fuzzy_chars: int = 8) -> DataFrame:
    """docs with n_lines, n_removed, and text without the lines that have a duplicate at a smaller (doc_id, line number).

    Lines are judged on the input. Lines without a word stay, so an empty text stays as it is. Null text stays null, with
    n_lines 0. Rows with a null doc_id have no place in the order: they take no part and stay whole. Rows that repeat a
    doc_id hold the same places, which are judged together. Of lines at one place the first by words counts. Other columns stay,
    whatever their names, but n_lines and n_removed of docs are replaced. An empty table gives no rows. A line of any length takes time
    linear in its words, and one of under min_fuzzy_words words in its characters. Edits are of words or of characters, by the line's length (see above).
    """
    gone = duplicate_lines(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), min_fuzzy_words, min_fuzzy_chars)
    out = C.packed_row(docs).join(gone, F.col("row.doc_id") == F.col("__doc"), "left")
    text, numbers = F.col("row.text"), F.col("__gone")
    lines = lines_of(text)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(numbers, i)), "\n")
    return C.unpacked_row(
        out, docs.columns,
        text=F.when(numbers.isNull(), text).otherwise(kept),
        n_lines=F.when(text.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"),
        n_removed=F.when(numbers.isNull(), F.lit(0)).otherwise(F.size(numbers)).cast("long"),
    )


def op9_line_dedup(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as no from documents where text is not null),
n as (select doc_id, no, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as w from l),
e as (select *, array_to_string(w, ' ') as norm, (doc_id, no) as place from n),
d as (select norm, any_value(w) as w, min(place) as place from e where len(w) > 0 group by norm),
k as (select *, case when len(w) >= 8 then 'w' when length(norm) >= 8 then 'c' end as kind from d),
v as (select norm, place, kind, len(w) as n, i, array_to_string(w[:i - 1] || w[i + 1:], ' ') as var from k, unnest(range(1, len(w) + 1)) as t(i) where kind = 'w'
  union all select norm, place, kind, length(norm), i, substring(norm, 1, i - 1) || substring(norm, i + 1) from k, unnest(range(1, length(norm) + 1)) as t(i) where kind = 'c'),
sub as (select norm from (select norm, place, min(place) over (partition by kind, var, n, i) as least from v) where place > least),
ins as (select case when k.place > v.place then k.norm else v.norm end as norm from v join k on k.norm = v.var and k.kind = v.kind),
fuzzy as (select norm from sub union select norm from ins),
m as (select e.*, len(e.w) > 0 and (f.norm is not null or e.place > d.place) as gone from e left join d on e.norm = d.norm left join fuzzy f on e.norm = f.norm)
select doc_id, count(no)::bigint as n_lines, count(*) filter (gone)::bigint as n_removed,
  sha256(coalesce(string_agg(line, chr(10) order by no) filter (not gone), '')) as kept_sha256
from m group by doc_id
union all select doc_id, 0, 0, sha256('') from documents where text is null
"""
