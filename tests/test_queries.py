import math
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemill.plans.export_queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS FROM '{p}'")
    return c


def plain(table):
    names = sorted(table.column_names)
    none = lambda v: v is None or (isinstance(v, float) and math.isnan(v))
    return names, sorted(tuple("~" if none(v) else repr(v) for v in r) for r in zip(*[table[n].to_pylist() for n in names], strict=True))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, data, duck, name):
    assert plain(QUERIES[name](spark, data).toArrow()) == plain(duck.sql(ORACLE_SQL[name]).to_arrow_table())


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE_SQL.keys()))
def test_query_without_sql(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_sample_is_of_the_table_and_the_same_again(spark, data):
    events = {tuple(r) for r in spark.read.parquet(f"{data}/events.parquet").collect()}
    one, two = ({tuple(r) for r in QUERIES["sample_rows"](spark, data).collect()} for _ in range(2))
    assert len(one) == 100 and one == two and one <= events


def test_nothing_imports_llm():
    root = Path(__file__).parent.parent / "tidemill"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"tidemill\.llm|corpus_pipeline", p.read_text()), p


def test_streaming_sessions_are_those_of_the_whole_table(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("at"))
    whole = events.groupBy("user_id", F.session_window("at", "6 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", "w.start", "w.end", "n")
    out = QUERIES["streaming_sessions"](spark, data)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, whole.collect()))
    assert out.agg(F.sum("n")).first()[0] == events.count()


def test_a_mean_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    """One user's values add up to 477.00, so that 119.25 is a tie; added as doubles, an order of them is under it."""
    for i, values in enumerate([(99.09, 89.9, 130.32, 157.69), (99.09, 157.69, 89.9, 130.32)]):
        rows = spark.createDataFrame([(1, "view", v) for v in values], "user_id long, event_type string, value double")
        rows.coalesce(1).write.parquet(str(tmp_path / f"{i}" / "events.parquet"))
        assert QUERIES["hr_daily_filtered"](spark, str(tmp_path / f"{i}")).first()["mean_value"] == 119.3
