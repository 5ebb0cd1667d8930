import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemill.llm import position_bitmaps as P

NAMES = "text string, lang string, phrase string, n long, size int"


def brute(rows):
    """Every language's first phrases by their definition."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    out = []
    for lang in n:
        mine = {p: a for (x, p), a in f.items() if x == lang and len(p) > 1 and a >= 30}
        kept = []
        for p, a in mine.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in mine.items()):
                continue
            score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:2000], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(3)
    words = ["a", "B", "né", "the", "of", "ab", "x-1", "\x0bq", "\xa0"]
    rows = [(" \t".join(rng.choices(words, weights=[9, 5, 3, 9, 9, 2, 1, 1, 1], k=rng.randint(0, 90))).replace("ab", "ab."), rng.choice(["en", "fr", None])) for _ in range(150)]
    return [*rows, (None, "en"), ("", None), (" \n ", "xx"), ("the of " * 400, "en"), *[("New York, New York", "en")] * 40]


@pytest.mark.parametrize("shard", [16, 333, P.SHARD])
def test_is_its_definition_at_every_shard_size(spark, made, shard):
    df = spark.createDataFrame([(t, x, "clash", 1, 2) for t, x in made], NAMES).repartition(3)
    out = P.collocations(df, shard=shard)
    got = sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in out.collect())
    assert got == brute(made) and len(got) > 50


def test_empty_tables(spark):
    assert P.collocations(spark.createDataFrame([], NAMES)).collect() == []
    assert P.collocations(spark.createDataFrame([(None, None, "", 0, 0)], NAMES)).collect() == []


def test_long_pieces_over_slabs(spark, monkeypatch):
    """A piece longer than a shard and a slab counts every place once; monkeypatched here, so without workers."""
    monkeypatch.setattr(P, "SLAB", 40)
    text = b"one two three four five six seven " * 50
    assert b"".join(P._slabs(text)) == text and len(list(P._slabs(text))) > 20
    assert list(P._slabs(b"x" * 100)) == [b"x" * 100]


def test_bitmaps_are_the_places():
    rng = np.random.default_rng(5)
    places = rng.integers(1, 9, 1000).astype(np.int32)
    offsets, entries, bits, heads = P.bitmaps(places, 3)
    for word in range(2, 9):
        at = [b * 16 + i for b in range(len(offsets) - 1) for e in range(offsets[b], offsets[b + 1]) if entries[e] == word for i in range(16) if bits[e] >> i & 1]
        assert at == np.flatnonzero(places == word).tolist()
    assert sum(int(np.bitwise_count(h)) for h in heads) == 16 * (997 // 16) + 997 % 16


def test_query_is_its_sql(spark, data):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    want = con.sql(P.OP11_SQL).fetchall()
    got = P.op11_position_bitmaps(spark, data).collect()
    assert sorted(map(tuple, got)) == sorted(want) and want


def test_a_task_holds_few_shards_at_once(spark, monkeypatch):
    """However many shards a task writes, a row group, which it holds whole, has GROUP of them."""
    kept = []
    made = P.table
    monkeypatch.setattr(P, "table", lambda df, name, **how: kept.append((name, made(df, name, **how))) or kept[-1][1])
    docs = spark.createDataFrame([(i, f"a{i} b c d", "en") for i in range(300)], "doc_id long, text string, lang string").coalesce(1)
    P.phrases(docs, words=64)
    files = [x.removeprefix("file:") for x in dict(kept)["shards"].inputFiles()]
    sizes = [m.row_group(i).num_rows for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups)]
    assert sum(sizes) > 10 and max(sizes) <= P.GROUP
