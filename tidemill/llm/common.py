"""What the operators share: scratch tables, Arrow slicing and connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once.
SLICE_BYTES = 4 << 20
#: Edges that a task works on at once, at most, in a step over few edges.
EDGES = 100_000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A temporary one only in local mode, where that is unset; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: executors need a folder that they share")
        found = tempfile.mkdtemp(prefix="tidemill-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/tidemill/{uuid.uuid4().hex}/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's file system, whichever it is."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def having(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Within it, what runs has this setting."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def tidy(spark: SparkSession):
    """Within it, a query's shuffle files go when the query has ended, not when the driver collects its garbage."""
    return having(spark, CLEANUP, "true")


def few_at_once(spark: SparkSession, rows: int = 1000) -> None:
    """From here on at most so many rows go to a Python worker at once, so that whole texts of many rows aren't held beside each other.

    It stays set, as a stage's rows are made after the stage has returned.
    """
    spark.conf.set(BATCH_ROWS, str(rows))


def table(df: DataFrame, name: str, batch: int = 1000, codec: str = "snappy", group: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors.

    So many rows at most go to a Python worker at once: fewer where rows are large. ``group``: the most rows of a
    row group, which is what a task holds when it writes or reads; without it, a task's first hundred rows are held at least.
    """
    spark = df.sparkSession
    with tidy(spark), having(spark, BATCH_ROWS, str(batch)):
        own = {} if group is None else {"parquet.block.row.count.limit": str(group), "parquet.page.row.count.limit": str(group)}
        df.write.options(compression=codec, **own).parquet(path := scratch(spark, name))
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A way to write tables to the shared folder that go at its end."""
    where = scratch(spark, "passing")

    def put(df: DataFrame, name: str) -> DataFrame:
        with tidy(spark):
            df.write.option("compression", "zstd").parquet(path := f"{where}/{name}-{uuid.uuid4().hex[:8]}")
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield put
    finally:
        remove(spark, where)


def give_back() -> None:
    """Hand what this Python has freed back to the system, where the C library can; else it counts as the process's until its end."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


_holder: dict[str, Callable[[], None]] = {}


def holds(name: str, drop: Callable[[], None] = lambda: None) -> None:
    """From here on this worker keeps the tables of the operator ``name``; those of others go by their ``drop``.

    A worker is used again by later stages, so without it what each of them keeps adds up.
    """
    if name in _holder:
        return
    others = [*_holder.values()]
    _holder.clear()
    _holder[name] = drop
    for other in others:
        other()
    if others:
        give_back()


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds about ``most`` bytes of text, or one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return [x or b"" for x in batch[text].cast(pa.binary()).to_pylist()]


def append(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b of one orderable type): rows (node, component).

    component is the smallest node that can be reached. Only nodes with an edge to another
    are returned; loops, nulls and repeated edges are harmless; no edges give no rows. Each
    round is a large star and a small star (Kiveris et al., 2014). The number of rounds
    grows with the logarithm of a component's width. A hub's neighbours are never gathered:
    a star is a join of the edges with one minimum for each node, and as both sides are
    tables in the shared folder, adaptive execution can split a hub's rows.
    """
    spark = edges.sparkSession
    where = scratch(spark, "components")

    def whole(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{where}/{name}")
        return spark.read.schema(df.schema).parquet(f"{where}/{name}")

    now = whole(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges0")
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # Tables of few edges are few files: a round is several small steps.
    tasks = -(-now.count() // EDGES)

    def put(df: DataFrame, name: str) -> DataFrame:
        return whole(df.coalesce(tasks), name)

    for i in range(1, most_rounds + 1):
        # Large star: each larger neighbour of u is linked to the smallest node around u.
        both = now.union(now.select("b", "a"))
        around = put(both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m")), f"around{i}")
        large = put(now.join(around, F.col("b") == F.col("u")).select("a", F.col("m").alias("b")).distinct(), f"large{i}")
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        below = put(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"), F.count("*").alias("n")), f"below{i}")
        rest = large.join(below.where("n > 1"), F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = put(rest.union(below.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), f"edges{i}")
        # Settled: nothing had two smaller neighbours, and no right end has a smaller one.
        done = rest.isEmpty() and after.join(after.select(F.col("a").alias("x")), F.col("b") == F.col("x"), "left_semi").isEmpty()
        for name in (f"edges{i - 1}", f"around{i}", f"large{i}", f"below{i}"):
            remove(spark, f"{where}/{name}")
        now = after
        if done:
            ends = now.select("b").distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(ends.select("b", "b"))
    raise RuntimeError(f"components have not settled in {most_rounds} rounds")
