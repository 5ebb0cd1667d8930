import re
import zlib
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest

from tidemill.llm import subsequence_svm as S
from tidemill.llm.common import give_back
from tidemill.llm.queries import QUERIES


def brute_kernel(a, b):
    """The normalised kernel by its definition, over all triples."""

    def phi(w):
        out = {}
        for i, j, k in combinations(range(len(w)), 3):
            u = (w[i], w[j], w[k])
            if S.MARK not in u:
                out[u] = out.get(u, 0) + S.DECAY ** (k - i - 2)
        return out

    x, y = phi(a), phi(b)
    dot = lambda p, q: sum(v * q.get(u, 0) for u, v in p.items())
    return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5


@pytest.mark.parametrize(("a", "b"), [("idiot", "idiot"), ("id.iot", "idiot"), ("idxiot", "idiots"), ("abc", "xyz"), ("aaaa", "aaa"), ("né", "nez")])
def test_kernel_is_its_definition(a, b):
    x, y = S.coded(a.encode())[0], S.coded(b.encode())[0]
    assert S._matrix([S.features(x)], [S.features(y)])[0, 0] == pytest.approx(brute_kernel(x, y), abs=1e-5)


def test_folded_table_gives_the_machines_margins():
    rng = np.random.default_rng(1)
    letters = np.array(list("abcdeéß."))
    words = ["a" + "".join(rng.choice(letters, rng.integers(1, 12))) + "b" for _ in range(60)]
    base = [S.features(S.coded(w.encode())[0]) for w in words[:10]]
    c = rng.normal(size=10)
    table = np.zeros(S.LETTERS**3, np.float32)
    for x, f in zip(c, base, strict=True):
        table[f.keys] += x * f.values
    made = S.Scorer(S.Model("k", table, -0.25, np.zeros(4))).margins([w.encode() for w in words])
    true = S._matrix([S.features(S.coded(w.encode())[0]) for w in words], base) @ c
    assert made == pytest.approx(np.maximum(true, 0) - 0.25, abs=1e-4)


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    clean = ["".join(rng.choice(["th", "er", "on", "an", "re", "ti", "es", "in"], 3)) for _ in range(300)]
    bad = ["idiot", "moron", "worthless"]
    found, y = [], []
    for i in range(300):
        text = [*rng.choice(clean, 60)]
        if i % 3 == 0:
            text[5], text[20] = rng.choice(bad, 2)
        found.append(" ".join(text).encode())
        y.append(int(i % 3 == 0))
    return S.train(found, np.array(y), landmarks=80)


@pytest.mark.parametrize(("text", "toxic"), [("theron an idiot moron esin", 1), ("an i.d.i.o.t and a mor-on", 1), ("you i d i o t moron", 1), ("idxiot worthlless ther", 1), ("theron anre tiesin", 0), ("", 0), ("idea worth more on", 0)])
def test_gapped_and_inserted(model, text, toxic):
    score = S.probability(S.Scorer(model)([text.encode()]), model.curve)[0]
    assert (score >= S.THRESHOLD) == bool(toxic)


def test_query_on_held_out(spark, data):
    """On the held-out rows of sf0.01."""
    at = data.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{at}/labels.parquet").collect()}
    out = QUERIES["op1_subsequence_svm"](spark, at).collect()
    assert len(out) == spark.read.parquet(f"{at}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in out)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) / len(held) >= 0.95
    toxic, clean = ([r["score"] for r in out if r["held_out"] and labels.get(r["doc_id"]) == y] for y in (1, 0))
    assert sum(x >= S.THRESHOLD for x in toxic) >= 0.7 * len(toxic)  # recall: a constant would pass by accuracy
    assert sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) >= 0.9 * len(toxic) * len(clean)


def test_choice_of_labelled_rows(spark, monkeypatch):
    """Whatever order rows come in, the same are learnt from; labels that cancel out and bytes beyond the bound aren't."""
    rows = [(i, f"text {i} " + "x" * 90) for i in range(60)] + [(7, "another text of one id")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, 0)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(S, "train", lambda found, y: seen.append((found, y.tolist())))
    for order in (rows, rows[::-1]):
        S.fitted(spark.createDataFrame(order, "doc_id long, text string").repartition(5), labels, sample=10)
    assert seen[0] == seen[1] and 10 <= len(seen[0][0]) <= 21 and sum(seen[0][1]) >= 9
    assert not any(x.startswith(b"text 3 ") for x in seen[0][0])
    S.fitted(spark.createDataFrame(rows, "doc_id long, text string"), labels, sample=10, most_bytes=500)
    assert 0 < len(seen[2][0]) < len(seen[0][0]) and sum(map(len, seen[2][0])) <= 500


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (6, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    for docs, n in ((odd, 12), (none, 0)):
        out = S.toxicity(docs, S.fitted(docs, labels))
        assert out.columns.count("score") == 1 and out.count() == n
        assert out.where("score IS NULL OR score NOT BETWEEN 0 AND 1").count() == 0


def test_freed_memory_goes_back_after_training(spark, data, monkeypatch):
    """What the driver's Python has freed isn't kept: of 200 MB in pieces under another one, at least half goes; and training does so at its end."""
    held = lambda: int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) // 1024
    pieces = [bytearray(b"x" * 100_000) for _ in range(2000)]
    before, pieces = held(), pieces[-1:]
    give_back()
    assert len(pieces) == 1 and held() <= before - 100
    called = []
    monkeypatch.setattr(S, "give_back", lambda: called.append(1))
    S.fitted(*(spark.read.parquet(f"{data}/{x}.parquet") for x in ("documents", "labels")))
    assert called == [1]


def test_words_are_scored_once_and_kept_by_use(monkeypatch):
    """Words of one form have one margin and are worked on once; what is met in every slice stays when words that aren't met again go."""
    scorer, worked = S.Scorer(S.Model("k", np.ones(S.LETTERS**3, np.float32), -0.25, np.zeros(4))), []
    raw = scorer._raw
    monkeypatch.setattr(scorer, "_raw", lambda batch: worked.append(len(batch)) or raw(batch))
    assert len({*scorer.margins([b"idiot", b"Idiot,", b"(IDIOT)"])}) == 1 and worked == [1]
    monkeypatch.setattr(S, "MOST_WORDS", 40)
    worked.clear()
    for i in range(50):
        scorer([b"the same words come " + b" ".join(b"w%dx%d" % (i, j) for j in range(6))])
    assert sum(worked) == 4 + 50 * 6 and len(scorer.met) + len(scorer.before) <= 40


def test_lengths_of_features_by_matrices():
    rng = np.random.default_rng(2)
    for n in range(4, 21):
        batch = rng.integers(1, 6, (20, n)).astype(np.uint8)
        brute = [sum(v * v for v in phi.values()) ** 0.5 for phi in map(triples, batch.tolist())]
        assert S.norms(batch) == pytest.approx(np.maximum(brute, 1e-6), rel=1e-4)


def triples(w):
    out = {}
    for i, j, k in combinations(range(len(w)), 3):
        if S.MARK not in (w[i], w[j], w[k]):
            out[w[i], w[j], w[k]] = out.get((w[i], w[j], w[k]), 0) + S.DECAY ** (k - i - 2)
    return out


def test_a_worker_keeps_one_operators_tables():
    from tidemill.llm import common

    kept = {"packing": [1], "toxicity": [2]}
    common.holds("packing", kept["packing"].clear)
    common.holds("packing", kept["packing"].clear)
    assert kept["packing"] == [1]
    common.holds("toxicity", kept["toxicity"].clear)
    assert kept == {"packing": [], "toxicity": [2]}
    common.holds("fingerprints")
    assert kept["toxicity"] == []
