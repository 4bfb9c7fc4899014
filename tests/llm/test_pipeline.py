"""Each pipeline stage on its own input, against SQL on that input, brute force or the library."""

import hashlib
import re

import duckdb
import pyarrow as pa
import sentencepiece

import corpus_pipeline
from tests.llm.test_brute_force import SF, bits
from tidemark.llm import queries, sentencepiece_bpe
from tidemark.llm.common import table

WORD = re.compile("[^\x20\x09-\x0d]")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def oracle(name, rows):
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r.doc_id for r in rows], pa.int64()), **{c: pa.array([r[c] for r in rows], pa.string()) for c in ("text", "lang", "source")}}))
    con.execute(f"create view benchmark as select * from '{SF}/benchmark.parquet'")
    asked = con.execute(queries.ORACLES[name])
    names = [c[0] for c in asked.description]
    return [dict(zip(names, r, strict=True)) for r in asked.fetchall()]


def after_lines(rows):
    """Documents that stay, with the length and hash that their text must have."""
    found = {}
    held = {r["doc_id"]: r for r in oracle("op9_line_dedup", rows)}
    for r in rows:
        got, text = held[r.doc_id], r.text or ""
        wordless = "\n".join(x for x in text.split("\n") if not WORD.search(x))
        if got["n_removed"] == 0 or got["kept_sha256"] != sha(wordless):
            found[r.doc_id] = got["kept_sha256"]
    return found


def one_of_each(rows):
    prints = [(r.doc_id, bits(r.text)) for r in rows]
    root, before = {d: d for d, _ in prints}, None
    while root != before:
        before = dict(root)
        for a, x in prints:
            root[a] = min(root[b] for b, y in prints if (x ^ y).bit_count() <= 2)
    return {d for d in root if root[d] == d}


def test_stages(spark):
    docs, columns = table(spark, SF, "documents"), corpus_pipeline.COLUMNS
    rows = docs.collect()
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.C.staged(stage(spark, docs, SF), f"test-{name}")
        got = out.collect()
        ids = {r.doc_id for r in got}
        assert len(ids) == len(got)
        before = {r.doc_id: r for r in rows}
        if name == "line_dedup":
            want = after_lines(rows)
            assert {r.doc_id: sha(r.text or "") for r in got} == want
            assert all(r.text is None or r.n_chars == len(r.text) for r in got)
            assert all((r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source) for r in got)
        elif name == "sentencepiece":
            sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.model_path())
            assert ids == set(before)
            for r in got:
                want = sp.encode(before[r.doc_id].text or "")
                assert (r.n_tokens, r.token_ids, r.text) == (len(want), ",".join(map(str, want)), sp.decode(want))
        else:
            if name == "quality_rules":
                want = {r["doc_id"] for r in oracle("op10_quality_rules", rows) if r["kept"]}
            elif name == "simhash_dedup":
                want = one_of_each(rows)
            else:
                want = set(before) - {r["doc_id"] for r in oracle("op6_decontaminate", rows)}
            assert ids == want
            assert all(tuple(r[c] for c in columns) == tuple(before[r.doc_id][c] for c in columns) for r in got)
        if name != "sentencepiece":
            assert out.columns == columns
        seen.append(len(got))
        docs, rows = out, got
    assert seen[0] < table(spark, SF, "documents").count() and seen[-1] > 0


def test_quality_stage_removes_frequent_lines(spark):
    own = [" ".join(f"w{i}x{k}" for k in range(30)) for i in range(60)]
    docs = spark.createDataFrame([(i, f"Read  More here\n{t}\n\nlast {i}", "a", "host", 1) for i, t in enumerate(own)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.stage_quality(spark, docs, SF).collect()}
    want = {i: f"{t}\n\nlast {i}" for i, t in enumerate(own)}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_benchmark_stage_is_native(spark, monkeypatch):
    plans, staged = [], corpus_pipeline.C.staged
    monkeypatch.setattr(corpus_pipeline.C, "staged", lambda df, tag: plans.append(df._jdf.queryExecution().executedPlan().toString()) or staged(df, tag))
    item = table(spark, SF, "benchmark").first().text
    docs = spark.createDataFrame([(1, f"x {item} y"), (2, "x y"), (None, item)], "doc_id long, text string").selectExpr("*", "'a' as lang", "'b' as source", "1L as n_chars")
    assert sorted(r.doc_id or 0 for r in corpus_pipeline.stage_benchmark(spark, docs, SF).collect()) == [0, 2]
    assert plans and not any(x in p for p in plans for x in ("Python", "Pandas", "Arrow"))
