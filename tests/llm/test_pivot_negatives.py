import duckdb
import numpy as np
import pytest

from tidemill.llm import pivot_negatives as P

NAMES = "vec_id long, embedding array<double>, label int, v string, rb int, to_row string"


def brute(rows):
    """By the definition: all anchors, all rows."""
    rows = sorted(rows)
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731, B905
    for i, own, q in rows:
        if i % 50:
            continue
        all_ = sorted((-score(q, v), j, y) for j, y, v in rows if j != i)
        for p, j, _ in [x for x in all_ if x[2] == own][:5]:
            good = [(n, k) for n, k, y in all_ if y != own and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out += [(i, j, r, k, -p, -n) for r, (n, k) in enumerate(good, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def test_is_its_definition(spark, monkeypatch):
    """Ties, copies, zero vectors, few rows of a label and more than one block of either side."""
    monkeypatch.setattr(P, "ROWS", 100)
    monkeypatch.setattr(P, "ANCHORS", 4)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(6, 5))
    rows = [(i, (base[rng.integers(6)] * rng.choice([0.5, 1, 1, 2]) + rng.choice([0, 0, 0.1], 5)).tolist(), int(rng.integers(3))) for i in range(600)]
    rows += [(600 + i, [0.0] * 5, 1) for i in range(10)] + [(-50, base[0].tolist(), 0), (650, base[1].tolist(), 77), (700, [1.0], 0)]
    df = spark.createDataFrame([(*r, "v", 1, "x") for r in rows], NAMES).repartition(4)
    want = brute([(i, y, [int(np.floor(256 * x)) for x in v]) for i, v, y in rows])
    assert found(P.hard_negatives(df)) == want and len(want) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, None, 1), (50, [1.0, None], 1), (100, [nan, 1.0], 1), (150, [inf, 1.0], 1), (200, [1.0, 1.0], None), (None, [1.0], 1), (250, [], 1)]
    fine = [(300, [1.0, 1.0], 1), (301, [1.0, 1.0], 1), (302, [0.5, 0.5], 2), (302, [0.5, 0.5], 2), (303, [0.9, 0.9], 2), (304, [3.0, 3.0], 2)]
    df = spark.createDataFrame([(*r, "v", 1, "x") for r in odd + fine], NAMES)
    # 250's empty vector scores 0 for everything; 302 is one row; 304 is over and 303 within the band.
    got = found(P.hard_negatives(df))
    assert [r for r in got if r[0] == 300] == [(300, 301, 1, 303, 131072, 117760), (300, 301, 2, 302, 131072, 65536)]
    assert {r[0] for r in got} <= {250, 300}


def test_large_components_and_empty_tables(spark):
    """Products over 2^53 are exact; no rows, and no anchors, give none."""
    assert found(P.hard_negatives(spark.createDataFrame([], NAMES))) == []
    assert found(P.hard_negatives(spark.createDataFrame([(1, [1.0], 1, "", 1, "")], NAMES))) == []
    big = [(0, 1 << 22, 0), (1, (1 << 22) + 1, 0), (2, 3 << 20, 1), (3, (3 << 20) + 1, 1)]
    df = spark.createDataFrame([(i, [float(v)], y, "", 1, "") for i, v, y in big], NAMES)
    assert found(P.hard_negatives(df)) == brute([(i, y, [256 * v]) for i, v, y in big])


def test_brackets_hold_every_score(spark):
    rng = np.random.default_rng(7)
    x = np.floor(256 * rng.normal(size=(80, 8)))
    square = (x**2).sum(1).max()
    pivots = P._pivots(x[:20], square)
    rows = np.c_[x, np.sqrt(square - (x**2).sum(1))]
    to_row = np.sqrt(((rows[:, None] - pivots[None]) ** 2).sum(2))
    to_anchor = np.sqrt(((np.c_[x, np.zeros(80)][:, None] - pivots[None]) ** 2).sum(2))
    bounds = P._Bounds.__new__(P._Bounds)
    bounds.square = square
    least, most = bounds.brackets(to_anchor, to_row, (x**2).sum(1))
    assert ((least <= x @ x.T) & (x @ x.T <= most)).all()
    assert (most < (x @ x.T).max(1, keepdims=True)).mean() > 0.2  # they do discard


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_is_its_sql(spark, data, sf):
    at = data.replace("sf0.001", sf)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{at}/embeddings.parquet'")
    want = con.sql(f"SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ({P.OP12_SQL})").fetchall()
    assert found(P.op12_pivot_negatives(spark, at)) == sorted(want) and want
