import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemill.llm import license_automaton as L


def plain(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return words, sorted(places)


WORDS = ["mit", "MIT", "license", "License,", "apache", "general", "public", "gnu", "the", "under", "x", "é", "version", "2.0"]


@given(st.lists(st.sampled_from(WORDS), max_size=40), st.sampled_from([" ", "\n", "-", " é "]))
def test_base_phrases(words, between):
    text = between.join(words)
    s = L.automaton().scan(text.encode())
    assert (s.n_words, s.places) == (len(plain(text)[0]), plain(text)[1])


def longest_end(words, templates):
    """For each word, the longest run ending there that some template has, by definition."""
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    return [max((k for k in range(1, i + 1) if tuple(words[i - k : i]) in runs), default=0) for i in range(1, len(words) + 1)]


@given(st.lists(st.sampled_from("abc"), max_size=25))
def test_matching_statistics(text):
    templates = [("t", "a b a b c"), ("u", "b a b b a")]
    a = L.Automaton({}, templates)
    v = l = 0
    got = []
    for w in text:
        c = a.ids[w.encode()] if w.encode() in a.ids else 0
        while v and c not in a.next[v]:
            v = a.link[v]
            l = a.len[v]
        if c in a.next[v]:
            v, l = a.next[v][c], l + 1
        else:
            l = 0
        got.append(l)
    assert got == longest_end(text, [t.split() for _, t in templates])


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("x Licensed under the Apache License, Version 2.0. y", {"apache"}),
        ("Licensed under CC BY-NC 4.0", {"cc-by-nc"}),
        ("Permission is hereby granted, free of charge, to any good person obtaining a copy of this software", {"mit"}),
        ("Redistribution and use in source and binary forms, with or without change, are permitted provided that the following", {"bsd"}),
        ("the terms of the agreement", set()),
        ("", set()),
    ],
)
def test_spans(text, labels):
    a = L.automaton()
    assert {a.labels[s.template] for s in a.scan(text.encode()).spans} == labels


def test_whole_table(documents, rows):
    out = {r["doc_id"]: r for r in L.licenses(documents).collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        words, places = plain(t)
        r, base = out[i], {label for _, label in places}
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(places), ",".join(sorted(base)))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert base <= set(r["labels"].split(",")) | ({""} & {r["labels"]}) and 0 <= r["score"] <= 1
    assert any("cc-by-nc" in r["labels"] for r in out.values())


def test_odd_rows(odd, none):
    out = L.licenses(odd).collect()
    assert len(out) == 12 and {r["score"] for r in out} == {0.0}
    assert L.scans(odd).columns.count("spans") == 1 and L.scans(odd).count() == 12
    assert L.licenses(none).count() == 0


MIT, BSD, ISC, UNLICENSE = (next(t for x, t in L.TEMPLATES[::-1] if x == label and len(t) > 300) for label in ("mit", "bsd", "isc", "unlicense"))


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        (MIT, {"mit"}),  # though its disclaimer is in another licence too, which matches less
        (UNLICENSE, {"unlicense"}),
        (MIT[600:], {"mit"}),
        (L._AS_IS, {"mit", "unlicense"}),  # this sentence is both's
        (BSD[700:], {"bsd"}),
        (f"{MIT} some other words of one's own {BSD}", {"mit", "bsd"}),
        ("the BSD 3-Clause License", {"bsd"}),
        ("under the GNU Lesser General Public License v2.1 or later", {"lgpl"}),
        (ISC[-200:], {"isc"}),
        ("", set()),
    ],
)
def test_later_passages_and_dominance(text, labels):
    a = L.automaton()
    assert {a.labels[s.template] for s in a.scan(text.encode()).spans} == labels


def test_chains_take_any_place_of_a_template():
    """A run that a template has twice goes on from either place."""
    a = L.Automaton({}, [("t", "a b c d e f g h x y a b c d i j k l m n")])
    for text, span in (("a b c d i j k l", (10, 18, 8)), ("a b c d e f g h", (0, 8, 8)), ("a b c d q i j k l", (10, 18, 8))):
        [s] = a.scan(text.encode()).spans
        assert (s.at, s.to, s.matched) == span
    two = a.scan(b"a b c d e f g h " + b"z " * 40 + b"a b c d i j k l").spans
    assert [(s.start, s.end) for s in two] == [(0, 8), (48, 56)]


def test_many_matches_take_time_in_proportion():
    """Notices repeated without end: the spans are those of one, over and over, and the time is the text's."""
    import time

    made = L.automaton()
    unit = (" ".join(t for _, t in L.TEMPLATES) + " foo ").encode()
    one = made.scan(unit)
    began = time.process_time()
    many = made.scan(unit * 400)
    assert time.process_time() - began < 30
    assert len(many.spans) >= 400 * (len(one.spans) - 2) and {s.template for s in many.spans} == {s.template for s in one.spans}
