import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemill.llm import chunk_bpe as B
from tidemill.llm import harmonic_packing as H

PATH = B.default_vocabulary()
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def same(text, library, chunks):
    ids = library.encode(text, add_special_tokens=False).ids
    got, decoded = chunks.encode(text.encode())
    return np.frombuffer(got, "<u4").tolist() == ids and decoded.decode() == library.decode(ids, skip_special_tokens=False)


@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'Aé\x01")), max_size=200))
@settings(max_examples=200, deadline=None)
def test_any_text_as_the_library(text):
    assert same(text, LIBRARY, B.chunks_of(PATH, True))


def test_chunks_repaired_and_reused(library, rows):
    random.seed(1)
    parts = ["a", "Z", "é", "ß", "İ", "Σ", "'s", " ", "\n", "\x1c", "\x85", "́", "中", "<|endoftext|>", "9", "!", "\x01", " ", "😀"]
    chunks = B.Chunks(PATH)
    made = ["".join(random.choices(parts, k=random.randint(0, 4000))) for _ in range(60)]
    passage = " ".join(random.choices(["one", "two", "three", "four"], k=3000))
    made += [f"{x} {passage} {x}" for x in "abc"] + ["".join(random.choices("abZé", k=9000)), "", "  "]
    assert all(same(t, library, chunks) for t in [*made, *(t for _, t in rows[:100])])
    assert chunks.reused > 0


def test_query_whole_table(documents, rows, library):
    out = {r["doc_id"]: r for r in B.digests(documents, PATH).collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert (out[i]["n_tokens"], out[i]["ids_sha256"], out[i]["decoded_sha256"]) == want


def test_small_tables_change_nothing(rows):
    words, chunks = B.Words(PATH, most=50), B.Chunks(PATH, most=100)
    for _, t in rows[:20]:
        assert words.encode(t.encode(), False)[0] == chunks.encode(t.encode())[0]


def test_texts_are_cut_once_and_words_made_together(library):
    """The ids of many texts at once; and tokens of words whose ids alone were asked for before."""

    class Text(bytes):
        cuts = 0

        def split(self, *a):
            Text.cuts += 1
            return super().split(*a)

    rng = random.Random(2)
    parts = ["a", "Z1", "é", "ß", "×", "÷", "İ", "'s", "<", "|", "<|endoftext|>", "9", "!", "\x01", "\x7f", "中", " ", " "]
    made = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(300)]
    words = B.Words(PATH, most=200)
    ids = [library.encode(t, add_special_tokens=False).ids for t in made]
    assert [np.frombuffer(x, "<u4").tolist() for x in words.ids_of([Text(t.encode()) for t in made])] == ids
    assert Text.cuts == len(made)
    for t, want in zip(made, ids, strict=True):
        assert words.encode(t.encode(), True)[1][:-1].decode() == library.decode(want, skip_special_tokens=False)


def check_packed(out, ids_of):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append(r)
    padding = total = 0
    for spans in sequences.values():
        spans.sort()
        at = 0
        for offset, length in spans:
            assert offset == at
            at += length
        assert at <= H.CAPACITY
        total += at
        padding += 0 if at & at - 1 == 0 else H.CAPACITY - at
    assert padding == 0
    for i, pieces in documents.items():
        ids, at = ids_of(i), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    return total


def test_packing_whole_table(documents, rows, library):
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, H.END] for i, t in rows}
    for docs in (documents.repartition(7), documents.coalesce(1)):
        total = check_packed(H.packed_words(docs).collect(), ids.__getitem__)
        assert total == sum(map(len, ids.values()))


@given(st.lists(st.integers(1, 5000), max_size=300))
def test_bins_hold_a_fixed_count_of_their_class(lengths):
    bins = H.Bins(0)
    full = [r for i, n in enumerate(lengths) for r in bins.put(i, bytes(4 * n))]
    assert all(len(v) < k and all(H.CAPACITY // p.length == k for p in v) for k, v in bins.open.items())
    out = full + [*bins.close()]
    assert sum(r[2] for r in out) == sum(lengths)
    closed = defaultdict(list)
    for r in full:
        closed[r[5]].append(r)
    for rows_ in closed.values():
        assert sum(r[2] for r in rows_) == H.CAPACITY
        # The pieces that end their document in whole come first; all but fillers' are of one class, as many as it holds.
        whole = [r[2] for r in rows_ if r[1] == r[4] // H.CAPACITY * H.CAPACITY and r[1] + r[2] == r[4]]
        kinds = Counter(H.CAPACITY // n for n in whole if n)
        assert rows_[0][2] == H.CAPACITY or any(kinds[k] >= k for k in kinds)


def test_most_documents_stay_whole(documents):
    pieces = Counter(r["doc_id"] for r in H.packed_words(documents.coalesce(1)).where(f"doc_tokens <= {H.CAPACITY}").collect())
    assert sum(n == 1 for n in pieces.values()) >= 0.8 * len(pieces)


def test_odd_rows(odd, none):
    out = B.digests(odd, PATH).collect()
    assert len(out) == 12 and sorted(r["n_tokens"] for r in out if r["doc_id"] in (2, 3, 4)) == [0, 0, 0]
    assert B.encoded(odd, PATH).columns.count("ids") == 1
    packed = H.packed_words(odd).collect()
    assert sum(r["start"] == 0 for r in packed) == 12
    assert B.digests(none, PATH).count() == H.packed_words(none).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        H.packed_words(odd, capacity=1000)
