import hashlib
from collections import Counter
from math import log

import numpy as np
import pytest

from tidemill.llm import weighted_fingerprints as W


def jaccard(a, b):
    x, y = ({w: 1 + log(n) for w, n in Counter(t.lower().split()).items()} for t in (a, b))
    keys = x.keys() | y.keys()
    return sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)


def test_collisions_are_generalised_jaccard():
    rng = np.random.default_rng(1)
    voc = np.array([f"w{i}" for i in range(60)])
    texts = [" ".join(rng.choice(voc[: rng.integers(20, 60)], 150)) for _ in range(24)]
    p = W.Fingerprinter(4096)([t.encode() for t in texts])
    for i in range(0, 24, 2):
        assert abs(W.likeness(p[i], p[i + 1]) - jaccard(texts[i], texts[i + 1])) < 0.04


def test_parts_and_a_full_table_change_nothing():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 50_000, n)).encode() for n in (10, 30_000, 0, 5000, 3)]
    small, large = W.Fingerprinter(16, table_rows=1), W.Fingerprinter(16)
    assert (small(texts) == np.vstack([large([t]) for t in texts])).all()


def test_against_edits_whole_table(documents, rows):
    out = {r["doc_id"]: r for r in W.against_edits(documents).collect()}
    assert len(out) == len(rows)
    made = W.Fingerprinter()
    for (i, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        n = len(text) // 2
        changed = (text[: len(text) - n] + after[:n]).encode()
        r, p = out[i], made([text.encode(), changed, after.encode()])
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed).hexdigest())
        assert [r["fingerprint"], r["edited_fingerprint"]] == W.hexed(p[:2])
        assert (r["near_edited"], r["near_next"]) == (W.likeness(p[0], p[1]), W.likeness(p[0], p[2]))


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_order_over_any_ranges(documents, rows, n):
    got = [r for part in W.in_order(documents.repartition(3), n).select("extra", "doc_id").rdd.glom().collect() for r in [tuple(part)]]
    ids = sorted(r["doc_id"] for part in got for r in part if r["extra"] == 0)
    assert ids == [i for i, _ in rows]
    follows = {}
    for part in got:
        own = [r["doc_id"] for r in part]
        follows |= dict(zip(own, own[1:], strict=False))
    assert all(follows[a] == b for (a, _), (b, _) in zip(rows, [*rows[1:], rows[0]], strict=True))


def test_odd_rows(odd, none):
    out = W.against_edits(odd).collect()
    assert len(out) == 12 and all(0 <= r["near_next"] <= 1 for r in out)
    alike = {r["fingerprint"] for r in out if r["doc_id"] in (1, 5)}
    assert len(alike) == 1
    assert W.against_edits(none).count() == 0
    assert W.fingerprints(odd).columns.count("fingerprint") == 1
    lone = W.against_edits(odd.where("doc_id = 6")).first()
    assert lone["near_next"] == 1.0
