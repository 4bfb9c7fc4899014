"""Edge cases and brute-force versions of the training-data operators."""

import hashlib

import pytest
import sentencepiece

from tidemark.llm import decontaminate, language_id, line_dedup, lm_score, quality_rules, secret_scan, sentencepiece_bpe, simhash_dedup, substring_dedup, warc
from tidemark.llm.components import components

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "x") for i, t in rows], "doc_id long, text string, lang string, source string, h string")


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (5, LONG), (None, LONG), (6, "one"), (7, "a " * 5000), (8, "ü\n" * 50)]


@pytest.mark.parametrize("rows", [EDGE, []], ids=["edge", "empty"])
def test_edge_cases_do_not_crash(spark, rows):
    df = docs(spark, rows)
    n = len(rows)
    assert substring_dedup.op1_substring_dedup(df).count() == n
    got = language_id.op2_language_id(df).collect()
    assert len(got) == n and all(r.lang_pred == "und" for r in got if r.doc_id in (1, 2, 3))
    assert simhash_dedup.op3_simhash_dedup(df).count() == n
    assert secret_scan.op4_secret_scan(df).count() == n
    assert sentencepiece_bpe.op5_sentencepiece(df).count() == n
    assert lm_score.op7_lm_score(df).count() == n
    assert line_dedup.op9_line_dedup(df).count() == n
    assert quality_rules.op10_quality_rules(df).count() == n
    items = spark.createDataFrame([(1, " ".join(WORDS[10:60])), (2, None), (3, "")], "item_id long, text string")
    hits = sorted((r.doc_id or -1, r.item_id, r.start) for r in decontaminate.op6_decontaminate(df, items).collect())
    assert hits == ([(-1, 1, 10), (4, 1, 10), (5, 1, 10), (5, 1, 10)] if rows else [])


def test_substrings(spark):
    rows = [(1, LONG), (2, "x " + " ".join(WORDS[100:160]) + " y"), (3, " ".join(WORDS[100:149])), (4, LONG)]
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in substring_dedup.dedup_substrings(docs(spark, rows)).collect()}
    assert got[1][0] == 0 and got[2] == (60, "x y") and got[3][0] == 0 and got[4] == (400, "")


def test_lines_within_one_word(spark):
    a = "one two three four five six seven eight nine"
    rows = [(1, a + "\nkeep"), (2, a.replace("five", "FIVE")), (3, a + " ten"), (4, a.replace("five", "5").replace("six", "6")), (5, "short line"), (6, "short  line\nshort lines")]
    got = {r.doc_id: (r.n_removed, r.text) for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert [got[i][0] for i in range(1, 7)] == [0, 1, 1, 0, 0, 2] and got[6][1] == ""


def test_short_lines_within_one_character(spark):
    """Under eight words an edit is of one character, from eight characters on."""
    lines = ["read more", "read mure", "read mor", "readmore", "read more!!", "sub menu", "SUB menu", "page 1", "page 2", "🙂 smile on", "🙃 smile on", " smile on", "b" * 300, "b" * 150 + "c" + "b" * 149, "b" * 301, "d" * 257, "d" * 256]
    lines += ["one two three four five six seven", "one two three four five six sevenx", "one two three four five six sev en", "one two three four five six other"]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs(spark, list(enumerate(lines)))).collect()}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    plain = [" ".join(x.split()) for x in lines]
    unit = ["w" if len(x.split()) >= 8 else "c" if len(x) >= 8 else "" for x in plain]
    want = {i: int(any(plain[k] == plain[i] or (unit[k] == unit[i] == "c" and near(plain[k], plain[i])) for k in range(i))) for i in range(len(lines))}
    assert got == want and sum(want.values()) == 8


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (None, 3)], "u long, v long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert set(roots[i] for i in range(41)) == {0} and roots[101] == 100


def test_sentencepiece_equals_library():
    path = sentencepiece_bpe.model_path()
    sp, coder = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_bpe.coder_for(path)
    for t in ["", " ", "  a  b ", "hello\nworld", "▁x▁▁ y", "漢字 ü 🙂\x00\x01", "a" * 300, "<0x0A> <s>", "\n\n a\n", "\t tab", "the the  the"]:
        ids = sp.encode(t)
        assert coder.encode(t) == (",".join(map(str, ids)), sp.decode(ids))


def test_warc_round_trip(spark):
    big = "é" * 600
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (None, "u", big)]
    got = {r.page_id: r for r in warc.op8_warc(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].record_type == "revisit" and got[1].refers_to == 2 and got[1].payload_bytes == 1200
    assert got[2].record_type == got[3].record_type == got[4].record_type == "response" and got[None].refers_to == 2
    assert got[5].payload_digest == hashlib.sha1(b"").hexdigest() and got[2].refers_to is None


def test_quality_rejects_depleted(spark):
    common = "the very same line of ten words that all documents have"
    rows = [(i, "\n".join([common] * 1 + [" ".join(f"u{i}x{k}" for k in range(25 if i % 2 else 2))])) for i in range(40)]
    kept = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs(spark, rows), min_docs=10, least_kept=0.5).collect()}
    assert all(kept[i] == bool(i % 2) for i in range(40))
