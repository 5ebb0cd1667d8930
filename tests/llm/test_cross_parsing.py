import random
import zlib

import pytest

from tidemill.llm import cross_parsing as C

SAMPLES = {"aa": b"the cat sat on the mat and the hat", "bb": "der hund läuft über die straße".encode(), "cc": b"zz"}


def greedy(sample, text):
    """Phrases by searching the sample for ever longer parts."""
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        n, i = n + 1, i + k
    return n


def test_automaton_and_table_are_longest_matches():
    rng = random.Random(1)
    made = C.model(SAMPLES)
    texts = ["".join(rng.choices("thecatsunlä ßxq", k=rng.randint(1, 200))).encode()[:200] for _ in range(50)] + [b"the cat sat", b"z", b"q", b" "]
    got = made.parse(texts)
    for i, x in enumerate(SAMPLES):
        auto = C.SuffixAutomaton(SAMPLES[x])
        for j, t in enumerate(texts):
            assert got[i, j] == auto.phrases(t) == greedy(SAMPLES[x], t)


def test_symbols():
    assert C.symbols("  ÉcOle 12,\tx\n".encode()) == "école x".encode()
    assert C.symbols(b"!1 ") == b""


def test_sections_are_added_up(monkeypatch):
    made = C.model(SAMPLES)
    text = b"the cat sat on the mat " * 400
    parts = [C.symbols(text)[i : i + C.SECTION] for i in range(0, len(C.symbols(text)), C.SECTION)]
    monkeypatch.setattr(C, "LANES", 3)
    langs, scores = C.predictions(made, [text, b"", "die straße".encode()])
    assert langs == ["aa", "und", "bb"] and scores[1] == 0 and 0.5 <= scores[0] <= 1
    bits = made.parse(parts).sum(1) * made.bits
    assert scores[0] == pytest.approx(sorted(bits)[1] / sum(sorted(bits)[:2]))


def test_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(C, "TABLE_CELLS", 2000)
    assert len(C.model(SAMPLES).table) <= 2000


def test_odd_rows(spark, odd, none):
    labelled = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("the quick brown fox", "en"), ("le renard brun", "fr"), (None, "de"), ("kein", None), ("", "it")])], "doc_id long, text string, lang string")
    made = C.learn(labelled)
    assert made.langs == ["en", "fr"]
    rows = C.identify(odd.withColumnRenamed("score", "lang_pred"), made).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) and 0 <= r["score"] <= 1
    assert C.identify(none, made).collect() == []
    nothing = C.learn(labelled.where("false"))
    assert {r["lang_pred"] for r in C.identify(odd, nothing).collect()} == {"und"}


def test_query_on_held_out(spark, data):
    at = data.replace("sf0.001", "sf0.01")
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{at}/documents.parquet").collect()}
    rows = C.op13_cross_parsing(spark, at).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]] for r in rows if r["held_out"] and docs[r["doc_id"]]]
    assert sum(held) >= 0.98 * len(held)
