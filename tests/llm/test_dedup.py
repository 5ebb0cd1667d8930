import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemill.llm import set_pairs
from tidemill.llm import fuzzy_lines as L
from tidemill.llm import pivot_simhash as P
from tidemill.llm import streaming_dedup as D
from tidemill.llm.common import components


def groups(nodes, pairs):
    """Union-find: each node's smallest partner."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "loops", "none"])
def test_components(spark, kind):
    rng = np.random.default_rng(1)
    pairs = {"chain": [(i, i + 1) for i in range(40)], "star": [(39, i) for i in range(39)], "random": rng.integers(0, 80, (60, 2)).tolist(), "loops": [(1, 1), (2, 3), (3, 2), (2, 3)], "none": []}[kind]
    df = spark.createDataFrame([tuple(p) for p in pairs] + [(None, 1)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    real = [p for p in pairs if p[0] != p[1]]
    assert got == groups({x for p in real for x in p}, real)


def test_fingerprints_by_definition(rows):
    for _, t in rows[:40]:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t).encode().split()
        shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        bits = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert P.fingerprint(t.encode()) == (bits if w else 0)


def test_links_are_all_close_pairs(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60, np.uint64)
    all_ = {int(x) for x in base}
    for x in base:
        for k in (1, 2, 3):
            for _ in range(4):
                all_.add(int(x) ^ sum(1 << int(b) for b in rng.choice(64, k, False)))
    signed = [x - 2**64 if x >= 2**63 else x for x in all_]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {(r["a"], r["b"]) for r in P.links(df).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}


def test_near_duplicates_whole_table(documents, rows):
    out = {r["doc_id"]: r for r in P.near_duplicates(documents).collect()}
    fp = {i: P.fingerprint(t.encode()) for i, t in rows}
    pairs = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2]
    want = groups(fp, pairs)
    degree = defaultdict(int)
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    assert {i: (r["fingerprint"], r["component_id"], r["links"]) for i, r in out.items()} == {i: (f"{fp[i]:016x}", want[i], degree[i]) for i in fp}
    kept = sorted(r["doc_id"] for r in P.one_of_each(documents).collect())
    assert kept == sorted(set(want.values()))


def test_near_odd_rows(odd, none):
    out = P.near_duplicates(odd)
    assert out.count() == 12
    empty = {r["component_id"] for r in out.where("doc_id IN (2, 3, 4)").collect()}
    assert empty == {2}
    kept = P.one_of_each(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 1").count() == 1 and kept.where("doc_id = 5").count() == 0
    assert P.near_duplicates(none).count() == P.one_of_each(none).count() == 0


def exact(rows):
    """By definition: of equal texts, the largest doc_id."""
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    known = lambda x: [i for i in x if i is not None]
    return sorted((str(i), str(max(known(g), default=None)), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in by.items() for i in g)


@pytest.mark.parametrize("digest", [D.sha256, lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 5), 2, "0"))])
def test_exact_duplicates(documents, odd, rows, digest):
    from tests.llm.conftest import ODD

    for docs, want in ((documents, rows), (odd, ODD)):
        out = D.exact_duplicates(docs, digest).collect()
        assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in out) == exact(want)
        assert sum(r["kept"] for r in out) == len({t or "" for _, t in want})
        assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


WANT = ["3", "4", "5", "6", "7", "7", "8", "None"]


def test_exact_rows_that_stay(odd, none):
    kept = D.without_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == WANT
    assert D.exact_duplicates(none).count() == D.without_duplicates(none).count() == 0


@pytest.mark.parametrize("digest", [D.sha256, lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 5), 2, "0"))])
def test_later_arrivals_hit_the_state_of_earlier_ones(spark, odd, none, tmp_path, digest):
    """Each arrival's result is that of a whole run over all rows so far, for its own rows."""
    from tests.llm.conftest import ODD

    state, sofar = str(tmp_path / "state"), []
    more = [(9, "x"), (10, "the quick brown fox jumps over the lazy dog"), (11, "new here"), (0, "y"), (None, None)]
    again = spark.createDataFrame(more, "doc_id long, text string")
    for docs, rows_ in ((odd, ODD), (none, []), (again, more)):
        out = D.arrived(docs, state, digest).collect()
        sofar += rows_
        want = exact(sofar)
        got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in out)
        assert got == sorted(x for i, t in rows_ for x in [next(w for w in want if w[0] == str(i) and w[3] == hashlib.sha256((t or "").encode()).hexdigest())])
    last = {r["doc_id"]: r for r in out}
    assert (last[9]["kept"], last[9]["group_size"], last[10]["group_size"], last[11]["group_size"]) == (True, 2, 4, 1)


def test_state_settings_are_put_back(spark, odd):
    before = spark.conf.get(D.PROVIDER, None)
    D.exact_duplicates(odd).count()
    assert spark.conf.get(D.PROVIDER, None) == before


def characters(line):
    """By definition: the nine characters from each position on."""
    line = line.strip(" \t\r")
    return {line[i : i + 9] for i in range(max(1, len(line) - 8))}


def line_links(lines):
    """All pairs of distinct lines with a Jaccard similarity of 0.8, by a whole index of shingles: no shingle is left out."""
    lines = sorted({*lines})
    sets = [characters(x) for x in lines]
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            index[g].append(i)
    out = []
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in index[g] if j < i)
        out += [(lines[j], lines[i]) for j, n in shared.items() if n >= L.SIMILAR * (len(s) + len(sets[j]) - n)]
    return out


def test_fuzzy_lines_against_all_pairs(spark, documents, rows):
    out = L.fuzzy_lines(documents).collect()
    lines = {x for _, t in rows for x in t.split("\n") if x.strip(" \t\r")}
    want = groups(lines, line_links(lines))
    text = dict(rows)
    made = defaultdict(set)
    for r in out:
        made[r["component"]].add(text[r["doc_id"]].split("\n")[r["line_no"]])
    for members in made.values():  # nothing is joined that isn't linked
        assert len({want[x] for x in members}) == 1
    true, missed = len(lines) - len(set(want.values())), len(made) - len(set(want.values()))
    assert true and missed <= 0.02 * true + 1
    assert sum(r["kept"] for r in out) == len(made)
    for r in out:
        if r["kept"]:
            assert (r["doc_id"], r["line_no"]) == (r["keep_doc_id"], r["keep_line_no"])


def components_of(spark, lines):
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    return [r["component"] for r in L.fuzzy_lines(docs).orderBy("doc_id").collect()]


def test_fuzzy_lines_of_templates(spark):
    """600 lines of 32 shared words, four of each pair's own and two of each line's own: 300 links, all in hot buckets."""
    rng = np.random.default_rng(3)
    word = lambda: f"{rng.integers(0, 2**32):08x}"
    shared, lines = [word() for _ in range(32)], []
    for _ in range(300):
        own = [word() for _ in range(4)]
        lines += [" ".join([*shared, *own, word(), word()]) for _ in range(2)]
    links = line_links(lines)
    assert len(links) >= 300
    by_line = dict(zip(lines, components_of(spark, lines), strict=True))
    assert sum(by_line[a] == by_line[b] for a, b in links) >= 0.97 * len(links)
    want = groups({*lines}, links)
    assert all(want[a] == want[b] for a in lines[:60] for b in lines[:60] if by_line[a] == by_line[b])


def test_fuzzy_very_long_lines(spark):
    rng = np.random.default_rng(4)
    long_ = " ".join(f"{x:06x}" for x in rng.integers(0, 2**24, 60_000))
    lines = [long_, long_ + " and more", "é" * 300_000, "z" * 300_000, "z" * 200_000, "short", "中", "😀" * 9]
    assert len(long_) > 2 * L.BLOCK
    got = components_of(spark, lines)
    assert got[0] == got[1] and got[3] == got[4] and len({*got}) == 6
    whole = L.band_keys([x.encode() for x in lines])
    assert (np.concatenate([L.band_keys([x.encode()]) for x in lines]) == whole).all()


def test_fuzzy_lines_take_out_copies(spark):
    a = "a line of some twenty words that says nothing at all but says it at length and then comes to its very end"
    docs = spark.createDataFrame([(2, f"{a}\n\nother words here"), (1, f"first\n{a}."), (3, None), (None, a), (4, "中文没有空格的一行文字也应当被比较而且不会被漏掉\n中文没有空格的一行文字也应当被比较而且不会被漏掉！")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in L.without_fuzzy_lines(docs).collect()}
    assert out == {1: f"first\n{a}.", 2: "\nother words here", 3: None, None: "", 4: "中文没有空格的一行文字也应当被比较而且不会被漏掉"}


def test_fuzzy_odd_rows(odd, none):
    assert L.without_fuzzy_lines(odd).columns == odd.columns
    assert L.without_fuzzy_lines(odd).count() == 12
    assert L.fuzzy_lines(none).count() == 0


def test_fuzzy_lines_of_a_hot_bucket(spark):
    """Pairs that all share a passage: of those that share a band, none of 0.8 or more is missed."""
    rng = np.random.default_rng(5)
    passage = " ".join(f"{x:08x}" for x in rng.integers(0, 2**32, 60))
    word = lambda: f"{rng.integers(0, 2**32):08x}"
    lines = []
    for _ in range(150):
        own = [word() for _ in range(7)]
        lines += [" ".join([passage, *own, *(word() for _ in range(6))]) for _ in range(2)]
    keys = dict(zip(lines, map(set, L.band_keys([x.encode() for x in lines]).tolist()), strict=True))
    linked = [(a, b) for a, b in line_links(lines) if keys[a] & keys[b]]
    assert len(linked) >= 100
    by_line = dict(zip(lines, components_of(spark, lines), strict=True))
    assert [p for p in linked if by_line[p[0]] != by_line[p[1]]] == []
    assert len(set(by_line.values())) == len(set(groups({*lines}, linked).values()))


def test_fuzzy_lines_send_few_unlike_texts(spark, monkeypatch):
    """Groups of lines that share seven of ten words of a line: of pairs that meet, those of a similarity of 0.8 are all verified, and few others."""
    rng = np.random.default_rng(6)
    word = lambda: f"{rng.integers(0, 2**32):08x}"
    lines = []
    for _ in range(20):
        shared = [word() for _ in range(28)]
        own = [" ".join([*shared, *(word() for _ in range(7))]) for _ in range(12)]
        lines += [*own, *(f"{x} and on" for x in own[:3])]
    ids = {xxhash.xxh64_intdigest(x.encode(), 42): x for x in lines}
    sent, verified = set(), set_pairs.verified

    def spy(pairs, *rest):
        sent.update(frozenset(ids[i % 2**64] for i in (r["id"], r["id2"])) for r in pairs.collect())
        return verified(pairs, *rest)

    monkeypatch.setattr(set_pairs, "verified", spy)
    keys = dict(zip(lines, map(set, L.band_keys([x.encode() for x in lines]).tolist()), strict=True))
    alike = {frozenset(p) for p in line_links(lines)}
    assert sum(bool(keys[a] & keys[b]) for i, a in enumerate(lines) for b in lines[:i]) > 1000
    by_line = dict(zip(lines, components_of(spark, lines), strict=True))
    assert len(alike) >= 60 and all(len({by_line[x] for x in p}) == 1 for p in alike)
    assert len(sent - alike) < 0.1 * len(lines)


def test_fuzzy_sets_in_bulk_are_those_of_each_line():
    """Short, repeated, blank-ended and very long lines, side by side."""
    rng = np.random.default_rng(9)
    lines = [b"x", b" short \t", "中文😀".encode(), b"z" * 50, b"\xff broken \xfe", b"ab" * L.BLOCK]
    lines += ["".join(rng.choice(list("ab é中 "), int(n))).encode() + b"." for n in rng.integers(1, 3000, 300)]
    for got, line in zip(L.shingle_sets(lines), lines, strict=True):
        assert (got == L.shingle_set(line)).all() and len(got) == len(L.shingle_set(line))
    assert L.shingle_sets([]) == []


def test_fuzzy_bands_of_one_line_alone_go(spark):
    """Of 300 unlike lines and two that are alike, nearly no keys but those of the two are kept."""
    rng = np.random.default_rng(7)
    lines = [" ".join(f"{x:08x}" for x in rng.integers(0, 2**32, 12)) for _ in range(300)]
    lines.append(lines[0] + ".")
    found = L.repeated(L.signatures(spark.createDataFrame([(x,) for x in lines], "text string").coalesce(1))).collect()
    keys = L.band_keys([lines[0].encode(), lines[-1].encode()]).tolist()
    twice = {*keys[0]} & {*keys[1]}
    assert twice and sum(r["key"] in twice for r in found) == 2 * len(twice) and len(found) <= 2 * len(twice) + 2


def test_fuzzy_lines_see_every_character(spark):
    """Shingles are those of every position, so lines that differ within long words are different."""
    a, b = "2024-03-05T10:15 user logged in from the office network", "2024-03-06T23:59 user logged in from the office network"
    c, d = (f"invoice 1234567890{x} was paid in full by the customer" for x in ("111", "999"))
    for line in (a, b, c, "😀 ab😀cd中文 é efgh😀", "short"):
        assert len(L.shingle_set(line.encode())) == len(characters(line))
    for x, y in ((a, b), (c, d)):
        shared = len(np.intersect1d(L.shingle_set(x.encode()), L.shingle_set(y.encode())))
        assert shared == len(characters(x) & characters(y))
    assert len({*components_of(spark, [a, b, c, d])}) == 4


def test_one_of_each_takes_out_edited_copies(spark):
    """All pairs of a five-word Jaccard of 0.8 or more are linked, though their fingerprints differ in more than two bits."""
    rng = np.random.default_rng(8)
    passage = [f"p{x}" for x in rng.integers(0, 10**6, 60)]
    texts = []
    for i in range(60):
        w = [f"w{x}" for x in rng.integers(0, 10**6, int(rng.integers(60, 300)))] + (passage if i % 2 else [])
        texts.append(" ".join(w))
        for k in (1, 2, 4):
            copy = list(w)
            for at in rng.choice(len(w), k, False):
                copy[at] = "edited"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    fp = [P.fingerprint(t.encode()) for t in texts]
    ids = range(len(texts))
    alike = [(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    close = [(a, b) for a in ids for b in ids if a < b and (fp[a] ^ fp[b]).bit_count() <= 2]
    assert len(alike) > 100 and len({*alike} - {*close}) > 50
    kept = sorted(r["doc_id"] for r in P.one_of_each(docs, words=5).collect())
    assert kept == sorted(set(groups(ids, alike + close).values()))
    assert sorted(r["doc_id"] for r in P.one_of_each(docs).collect()) == sorted(set(groups(ids, close).values()))


def test_shingles_of_one_text_alone_go_before_the_search(spark):
    """Those of two rows stay with their places, whatever else shares the filter's bits; negative hashes and empty rows too."""
    rows = [(1, 3, 2, [5, -7, 9], [0, 1, 2]), (2, 2, 1, [-7, 11], [0, 1]), (3, 1, 1, [13], [0]), (4, 0, 0, [], []), (5, 1, 1, [9], [0])]
    firsts = spark.createDataFrame([(*r, [r[0]]) for r in rows], f"{set_pairs.FIRSTS}, parity array<long>")
    found = {r["id"]: (r["size"], r["short"], r["s"], r["at"], r["parity"]) for r in set_pairs.repeated(firsts).collect()}
    assert found == {1: (3, 2, [-7, 9], [1, 2], [1]), 2: (2, 1, [-7], [0], [2]), 5: (1, 1, [9], [0], [5])}
    assert set_pairs.repeated(firsts.limit(0)).count() == 0


def test_parities_lose_no_pair_that_is_alike(spark):
    """Sets of 1 to 5000 hashes with a similarity from 0 to 1: every pair of 0.8 or more stays, nearly all unlike ones of up to 2000 go."""
    r = np.random.default_rng(3)
    rows, pairs, alike, unlike = [], [], set(), set()
    for k in range(300):
        n = int(r.choice([1, 2, 9, 40, 300, 2000, 5000]))
        x = np.unique(r.integers(-(2**63), 2**63 - 1, n))
        swap = r.random(len(x)) < r.choice([0.0, 0.05, 0.1, 0.12, 0.5, 1.0])
        y = np.unique(np.where(swap, r.integers(-(2**63), 2**63 - 1, len(x)), x))
        same = len(np.intersect1d(x, y))
        for i, v in ((2 * k, x), (2 * k + 1, y)):
            rows.append((i, len(v), set_pairs.parities(v).tolist()))
        pairs.append((2 * k, 2 * k + 1))
        share = same / (len(x) + len(y) - same)
        if share >= 0.8:
            alike.add(2 * k)
        elif share < 0.5 and n <= 2000:
            unlike.add(2 * k)
    firsts = spark.createDataFrame(rows, "id long, size int, parity array<long>")
    stay = {p["id"] for p in set_pairs.near(spark.createDataFrame(pairs, "id long, id2 long"), firsts, 0.8).collect()}
    assert alike and alike <= stay
    assert unlike and len(unlike & stay) < 0.05 * len(unlike)


def test_a_large_group_of_near_copies_is_not_paired_as_a_whole(spark, monkeypatch):
    """Of 400 edits of one text, over a quarter of the pairs alike: most are joined before the search of all pairs, and the class is whole."""
    rng = np.random.default_rng(5)
    words = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
    texts = []
    for i in range(400):
        copy = list(words)
        for at in rng.choice(len(words), int(rng.integers(1, 5)), False):
            copy[at] = f"e{i}"
        texts.append(" ".join(copy))
    sets = [P.shingle_set(t.encode(), 5) for t in texts]
    same = lambda a, b: len(np.intersect1d(sets[a], sets[b], assume_unique=True))
    alike = [(a, b) for a in range(400) for b in range(a) if same(a, b) >= 0.8 * (len(sets[a]) + len(sets[b]) - same(a, b))]
    assert len(alike) > 20_000
    left, crossed = [], set_pairs.crossed

    def counted(*args):
        left.append(crossed(*args).distinct().count())
        return crossed(*args)

    monkeypatch.setattr(set_pairs, "crossed", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in P.one_of_each(docs, words=5).collect()) == sorted(set(groups(range(400), alike).values()))
    assert left[0] <= 40_000  # of 79,800 pairs; 82,638 rows when texts were held against one other alone, and pairs of equal sizes came twice


def test_shingle_sets_of_many_texts_at_once():
    """As of each text alone, and as many as there are: borders of texts and of blocks, long words, few words."""
    texts = [b"", b" \n ", b"a", b"a b", b"A B  c d e", b"a b c d e f" * 3, b"x" * 70 + b" y", b"q " * 200_000, b"z" * 600_000 + b" a b c d e f " + b"w" * 65 + b" " + b"w" * 64, b"a b c d e"]
    sets = P.shingle_sets(texts, 5)
    for x, got in zip(texts, sets, strict=True):
        w = x.lower().split()
        assert (got == P.shingle_set(x, 5)).all() and len(got) == len({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)) if w})
    assert (sets[4] == sets[9]).all() and P.shingle_sets([], 5) == []
