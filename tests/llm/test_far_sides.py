"""Both sides of every size switch, hot keys, clashing columns, very long texts, and searches without their index."""

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import common as C
from tidemark.llm import decontaminate, line_dedup, lm_score, quality_rules, secret_scan, simhash_dedup, substring_dedup, warc
from tidemark.llm.components import components

LINE = "one two three four five six seven eight nine"
ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, __doc string, __gone string, host string, spans string, kept string, n_removed string, c1 string, rules string, salt string, body string, __text string, `a.b` string"


def odd(spark, texts):
    """Rows with columns named like the operators' own."""
    return spark.createDataFrame([(i, t, None, None if i % 3 == 0 else "s", None, *["x"] * 13) for i, t in enumerate(texts)], ODD)


TEXTS = [None, "", " \n ", LINE, LINE, f"{LINE}\nown line here", LINE.replace("five", "FIVE"), LINE + " ten", "token: abcdefgh12345678", "token: abcdefgh12345678", "AKIA" + "Z" * 16, "f" * 40, "word " * 30, "word " * 30]
SHORT = ["a short line", "a short lime", "a short lines"]


def ordered(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def test_clashing_columns_pass(spark):
    df = odd(spark, TEXTS + SHORT)
    got = line_dedup.dedup_lines(df)
    assert set(df.columns) <= set(got.columns) and {r["__doc"] for r in got.collect()} == {"x"}
    assert {r.doc_id: r.n_removed for r in got.collect() if r.n_removed} == {4: 1, 5: 1, 6: 1, 7: 1, 9: 1, 13: 1, 15: 1, 16: 1}
    got = quality_rules.quality_rules(df)
    assert {r["a.b"] for r in got.collect()} == {"x"} and {r.doc_id for r in got.collect() if r.base_failed} == set(range(17))
    got = secret_scan.scan_secrets(df)
    assert {r.doc_id: [s["name"] for s in r.spans] for r in got.collect() if r.spans} == {8: ["assign"], 9: ["assign"], 10: ["access"], 11: ["hex"]} and {r.salt for r in got.collect()} == {"x"}
    for fn in (substring_dedup.op1_substring_dedup, simhash_dedup.op3_simhash_dedup, lm_score.op7_lm_score):
        assert fn(df).count() == len(TEXTS + SHORT)


def test_far_sides_equal_near_sides(spark, monkeypatch):
    common = "the very same line of words that many documents have"
    texts = TEXTS + SHORT + [f"{common}\n{' '.join(f'u{i}x{k}' for k in range(25 if i % 2 else 1))}" for i in range(40)]
    df = odd(spark, texts)
    queries = [
        lambda: line_dedup.dedup_lines(df).select("doc_id", "text", "n_removed"),
        lambda: quality_rules.quality_rules(df, min_docs=5, least_kept=0.5).select("doc_id", "n_common_words", "clean_text", "kept"),
        lambda: secret_scan.op4_secret_scan(df),
        lambda: simhash_dedup.near_duplicates(df),
    ]
    near = [ordered(q()) for q in queries]
    assert sum("True" in r for r in near[1]) == 20
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(line_dedup, "DIRECT", 11)
    monkeypatch.setattr(quality_rules, "BROADCAST_LINES", -1)
    monkeypatch.setattr(secret_scan, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(simhash_dedup, "BUCKET", 1)
    assert [ordered(q()) for q in queries] == near
    monkeypatch.setattr(C.hot_join, "__defaults__", ("__n", 0, 1))
    assert [ordered(q()) for q in queries] == near


def test_hot_join(spark):
    rows = spark.createDataFrame([(k, i) for k in range(20) for i in range(300 if k == 3 else 2)], "k int, i int")
    keyed = rows.groupBy("k").count().withColumnRenamed("count", "__n").withColumn("name", C.F.col("k") * 10)
    want = ordered(rows.join(keyed.drop("__n"), "k"))
    assert ordered(C.hot_join(rows, keyed, ["k"])) == want == ordered(C.hot_join(rows, keyed, ["k"], floor=0))


def test_hub_and_chain(spark):
    edges = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(500, 600)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(400)} | {i: 500 for i in range(500, 601)}


def test_very_long_line(spark):
    """Two lines of 100,000 words, one word replaced; and one with a word more."""
    w = [f"w{i % 977}" for i in range(100_000)]
    texts = [" ".join(w), " ".join([*w[:70_000], "other", *w[70_001:]]), " ".join([*w[:10], "more", *w[10:]]), " ".join(w[::-1])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df).collect()} == {0: 0, 1: 1, 2: 1, 3: 0}


def test_pairs_of_lines_are_verified(spark):
    """Lines that meet in a key but aren't within one edit aren't paired."""
    words = spark.createDataFrame([(1, 1, [1, 2, 3]), (2, 2, [1, 9, 3]), (3, 3, [7, 8, 3]), (4, 4, [1, 2, 5, 3])], "__k1 long, __k2 long, __w array<long>")
    pairs = spark.createDataFrame([(2, 2, 1, 1, False, False, 1), (3, 3, 1, 1, False, False, 1), (4, 4, 1, 1, True, False, 2), (4, 4, 3, 3, True, False, 2)], "__k1 long, __k2 long, l1 long, l2 long, long1 boolean, long2 boolean, del int")
    assert sorted((r["__k1"], r.l1) for r in line_dedup.verified(pairs, words).collect()) == [(2, 1), (4, 1)]


@pytest.mark.parametrize("n", [1, 2, 11, 54, 127, 128, 300])
def test_window_fingerprints(n):
    h = C.fnv_free_mix(np.arange(400, dtype=np.uint64))
    got = decontaminate.fingerprints(decontaminate._votes(h), n)
    bits = (h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    want = [sum(1 << b for b in range(64) if 2 * int(bits[a : a + n, b].sum()) > n) for a in range(len(h) - n + 1)]
    assert got.tolist() == want


def test_blocks_hold_all_within_the_radius():
    rng = np.random.default_rng(5)
    for _ in range(300):
        x = int(rng.integers(0, 2**63))
        y = x
        for b in rng.choice(64, rng.integers(0, decontaminate.RADIUS + 1), replace=False).tolist():
            y ^= 1 << b
        tables = decontaminate.block_tables(np.array([x], np.uint64))
        assert any(tables[i][(y >> (16 * i)) & 0xFFFF] & 1 for i in range(4))


def test_decontamination_finds_by_blocks(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    items = spark.createDataFrame([(i, " ".join(words[10 * i : 10 * i + 30 + i])) for i in range(20)] + [(90, " ".join(words[:200])), (91, "w5 w6 w7"), (92, None), (93, "")], "item_id long, text string")
    texts = ["  ".join(words).upper(), " ".join(words[40:110]), " ".join([*words[40:60], "x", *words[61:110]]), None, "", "w5 w6 w7", "w7 w6 w5 " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def exact(a, b, k):
        grams = lambda w: [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
        x, y = grams(a), grams(b)
        shared = sum(min(x.count(s), y.count(s)) for s in set(x))
        return shared / (len(x) + len(y) - shared)

    want = []
    for d, t in enumerate(texts):
        w = (t or "").lower().split()
        for r in items.collect():
            own = (r.text or "").split()
            found = [(exact(own, w[s : s + len(own)], min(5, len(own))), -s) for s in range(len(w) - len(own) + 1)] if own else []
            if found and max(found)[0] >= 0.8:
                want.append((d, r.item_id, round(max(found)[0], 6), -max(found)[1]))
    got = sorted(tuple(r) for r in decontaminate.op6_decontaminate(docs, items).collect())
    assert got == sorted(want) and len(got) > 25
    assert sorted(map(tuple, decontaminate.contaminated(docs, items, part=50).select("doc_id", "item_id", C.F.round("similarity", 6), "start").collect())) == got
    empty = decontaminate.Index([" ".join(words[:30])], 5)
    for g in empty.groups:
        g.tables[:] = 0
    raw = " ".join(words).encode()
    assert list(empty.search(C.Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), 0.8)) == []  # without the blocks nothing is found
    assert decontaminate.op6_decontaminate(docs.limit(0), items).count() == decontaminate.op6_decontaminate(docs, items.limit(0)).count() == 0


def test_archive_is_verified(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "HOT_ROWS", 3)
    big = "b" * 2000
    pages = [(i, "u", "error page") for i in range(30)] + [(100 + i, "u", big) for i in range(5)]
    path = f"file://{tmp_path}/a"
    warc.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    got = warc.read_back(spark, path).collect()
    assert len(got) == 35 and {r.refers_to for r in got} == {None, 104}
    lost = f"file://{tmp_path}/b"
    heads = spark.read.parquet(f"{path}/headers")
    heads.where("page_id <> 104").write.parquet(f"{lost}/headers")
    spark.read.parquet(f"{path}/payloads").write.parquet(f"{lost}/payloads")
    with pytest.raises(ValueError, match="4 revisits"):
        warc.read_back(spark, lost)
    assert warc.op8_warc(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_stages_take_odd_rows(spark):
    prose = " ".join(f"w{i}" for i in range(40))
    rows = odd(spark, [*TEXTS, prose, prose, prose + " end"])
    rows = rows.unionByName(rows.where("doc_id = 14")).unionByName(rows.where("doc_id = 14").withColumn("doc_id", C.F.lit(None).cast("long")))
    sf = "/root/testdata/sf0.001"
    kept = {
        "quality_rules": [None, 14, 14, 15, 16],
        "line_dedup": [None, 0, 1, 2, 3, 5, 8, 10, 11, 12, 14, 14],
        "simhash_dedup": [None, 0, 3, 5, 6, 7, 8, 10, 11, 12, 14, 14],
        "decontaminate": [None, *range(14), 14, 14, 15, 16],
        "sentencepiece": [None, *range(14), 14, 14, 15, 16],
    }
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, rows, sf)
        ids = sorted((r.doc_id for r in got.collect()), key=lambda x: -1 if x is None else x)
        if name == "simhash_dedup":  # near copies depend on their bits
            assert {None, 0, 3, 8, 10, 11, 12, 14} <= set(ids) and not {1, 2, 4, 9, 13, 15} & set(ids)
        else:
            assert ids == kept[name], name
        assert got.columns[: len(corpus_pipeline.COLUMNS)] == corpus_pipeline.COLUMNS
        assert stage(spark, rows.limit(0), sf).count() == 0


def test_decontamination_is_native(spark, monkeypatch):
    """No Python in the plan; short, laddered and long items, words that meet the trimmed characters, repeated words; nothing without the blocks."""
    words = [f"f{i}" for i in range(200)]
    items = spark.createDataFrame([(1, " ".join(words[:25])), (2, "fa fb"), (3, " ".join(words[20:180])), (4, "ab " * 30)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "\f" + " ".join(words) + "\x0b"), (2, "fa fb"), (3, "ab " * 40), (4, None)], "doc_id long, text string")
    out = decontaminate.op6_decontaminate(docs, items)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    want = [(1, 1, 1.0, 0), (1, 3, 1.0, 20), (2, 2, 1.0, 0), (3, 4, 1.0, 0)]
    assert sorted(map(tuple, out.collect())) == want
    monkeypatch.setattr(decontaminate, "ITEMS", 1)
    assert sorted(map(tuple, decontaminate.op6_decontaminate(docs, items).collect())) == want
    monkeypatch.setattr(decontaminate, "block_bits", lambda prints: np.zeros((8, 256), np.uint64))
    assert decontaminate.op6_decontaminate(docs, items).count() == 0
