import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
import xxhash

from tidemill.llm import hidden_markov as H


@pytest.fixture
def parameters():
    rng = np.random.default_rng(4)
    p = lambda *s: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(s))
    return p(3), p(3, 3), p(3, 5).T


def brute(x, start, moves, emits):
    """p(x) over all paths, and the expected counts of starts, moves and emissions."""
    total, starts, pairs, emitted = 0, np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for path in product(range(3), repeat=len(x)):
        p = start[path[0]] * np.prod([emits[o, s] for o, s in zip(x, path, strict=True)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:], strict=False)])
        total += p
        starts[path[0]] += p
        for a, b in zip(path, path[1:], strict=False):
            pairs[a, b] += p
        for o, s in zip(x, path, strict=True):
            emitted[o, s] += p
    return total, starts / total, pairs / total, emitted / total


def test_forward_and_expected_counts_are_those_of_all_paths(parameters):
    rng = np.random.default_rng(5)
    sequences = [rng.integers(0, 5, n) for n in (4, 1, 6, 3)]
    true = [brute(x, *parameters) for x in sequences]
    assert H.log10_likelihood(sequences, *parameters) == pytest.approx([math.log10(t[0]) for t in true])
    starts, pairs, emitted = H.expected(sequences, np.ones(4, bool), np.array([(0, len(x)) for x in sequences]), *parameters)
    for got, i in ((starts, 1), (pairs, 2), (emitted, 3)):
        assert got == pytest.approx(sum(t[i] for t in true), rel=1e-4, abs=1e-5)


def test_parts_count_each_token_and_each_transition_once(parameters):
    """Cut texts give nearly what whole ones give, and exactly as many tokens and transitions."""
    rng = np.random.default_rng(6)
    sequences = [rng.integers(0, 5, n) for n in (1000, 1, 256, 257, 530)]
    _, moves, _ = parameters
    whole = H.expected(sequences, np.ones(5, bool), np.array([(0, len(x)) for x in sequences]), *parameters)
    cut = H._summed(sequences, *parameters)
    assert cut[1].sum() == pytest.approx(sum(len(x) - 1 for x in sequences), rel=1e-5)
    assert cut[2].sum(axis=1) == pytest.approx(np.bincount(np.concatenate(sequences), minlength=5), rel=1e-5)
    for a, b in zip(whole, cut, strict=True):
        assert b == pytest.approx(a, rel=1e-3, abs=1e-2)
    assert H.stationary(moves) @ moves == pytest.approx(H.stationary(moves))


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(6)
    sequences = [(rng.integers(0, 10, 40) + 10 * (i % 2)).astype(np.int32) for i in range(40)]
    unigram = np.ones(20) / 20
    follows = np.zeros((20, 20))
    for s in sequences:
        np.add.at(follows, (s[:-1], s[1:]), 1)
    start, moves, emits = H.first_guess(follows, np.bincount([s[0] for s in sequences], minlength=20), 4)
    model, likely = (start, moves, emits.T), []
    for _ in range(4):
        likely.append(H.log10_likelihood(sequences, *model).sum())
        model = H.maximised(*H._summed(sequences, *model), unigram)
    assert likely[1:] == sorted(likely[1:])
    # The guess alone tells the two halves apart: better than any model without states.
    assert likely[0] > 0.9 * 40 * 40 * math.log10(1 / 20)


def test_scores_against_counts(spark, documents, rows):
    out = {r["doc_id"]: r for r in H.scores(documents, core=500, known=3000, states=6).collect()}
    assert len(out) == len(rows)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in H.tokens(t.encode()))
    n, v = sum(counts.values()), len(counts)
    better = []
    for i, t in rows:
        r, words = out[i], H.tokens(t.encode())
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(words), sum(w in counts for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), abs=1e-6)
        better.append((r["score"] - r["base_score"], r["n_tokens"], held(i)))
    for fold in (True, False):
        assert sum(d for d, _, h in better if h == fold) / sum(k for _, k, h in better if h == fold) > 0.1


def test_probabilities_add_up(spark, documents):
    counts = H.table(H.corpus_counts(documents.select("text")), "counts")
    top = H.known_words(counts, 2000)
    m, unigram, n, v = H.untrained(counts, top, 4, 300)
    assert counts.where(top).count() <= 2000
    assert m.emits.sum(axis=0) == pytest.approx(np.ones(4)) and m.moves.sum(axis=1) == pytest.approx(np.ones(4))
    words = counts.where("cls >= 0").collect()
    c = np.array(sorted((r["n"] for r in words), reverse=True))
    assert c.sum() == n and len(c) == v and unigram.sum() == pytest.approx(1)
    assert m.totals.sum() == (c + 1).sum() - (c[:300] + 1).sum()  # so that a class's words and one unknown have its whole probability
    assert m.log_counts[:300] == pytest.approx(np.log10(c[:300] + 1))
    follows = sum(r["n"] for r in counts.where(f"cls = {H.FOLLOWS}").collect())
    firsts = sum(r["n"] for r in counts.where(f"cls = {H.FIRSTS}").collect())
    assert firsts == documents.count() and follows == n - firsts


def test_odd_rows(odd, none):
    out = H.scores(odd, core=5, known=10, states=2).collect()
    assert len(out) == 12 and all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)
    assert {r["n_tokens"] for r in out if r["doc_id"] in (2, 3, 4)} == {1}
    assert H.scores(none).count() == 0
    nothing = H.scores(odd.where("doc_id = 6"), fold=1, held=0).first()
    assert nothing["train_tokens"] == 0 and nothing["n_known"] == 0


def test_words_are_hashed_once(monkeypatch):
    """Codes, hashes and ends of many texts at once are those of their tokens, also where what was met is dropped."""
    monkeypatch.setattr(H, "MOST_WORDS", 40)
    rng = random.Random(6)
    made = ["".join(rng.choices(["a", "B", "é", "İ", "x1", "中", "\x1c", " ", " ", "\t", "\n"], k=rng.randrange(20))).encode() for _ in range(200)]
    words = [w for t in made for w in H.tokens(t)]
    known = sorted({*words[::3]})
    h = H.hashes_of(known)
    index = H.Index(np.sort(h), np.argsort(h).astype(np.int32))
    want = [known.index(w) if w in known else -1 - H.class_of(w) for w in words]
    calls = []
    real = xxhash.xxh64_intdigest
    monkeypatch.setattr(H.xxhash, "xxh64_intdigest", lambda w: calls.append(w) or real(w))
    codes, hashes, last = index(H.flat_tokens(made))
    assert codes.tolist() == want and sorted(calls) == sorted({*words})
    assert hashes.view(np.uint64).tolist() == [real(w) for w in words] and last.tolist() == [w == H.END for w in words]
    some = [index(H.flat_tokens(made[i : i + 9])) for i in range(0, len(made), 9)]
    assert np.concatenate([x[0] for x in some]).tolist() == want
    assert H.flat_tokens([b"A \xff b", b"", b"c"]) == [b"a", "\ufffd".encode(), b"b", H.MARK, H.MARK, b"c", H.MARK] and H.flat_tokens([]) == []
