"""Publishing tables, texts and CSVs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.files import _fs, join, list_dirs


def write_table(df: DataFrame, base: str, table: str, partition_by: tuple[str, ...] = (), compression: str = "zstd", small: bool = False, dealt: bool = False) -> None:
    """Overwrite a table, or of a partitioned one only the partitions that ``df`` has rows for.

    Rows are dealt by partition value and a spread within it, so that a value gets few files
    and a large one more than one writer. ``small`` tables become a single file; rows that are ``dealt`` already,
    such as those of files by partition value, are written where they are.
    """
    writer = (df.coalesce(1) if small else df).write
    if partition_by:
        writer = (df if dealt else df.hint("rebalance", *partition_by)).write.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").option("compression", compression).parquet(join(base, table))


def content(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """(part, rows, mixed, summed): a digest of each partition's rows that doesn't depend on their order or files; repeated rows count."""
    part = F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by]) if partition_by else F.struct(F.lit("all").alias("all"))
    h = F.xxhash64(*sorted(df.columns))
    return df.select(part.alias("part"), h.alias("h")).groupBy("part").agg(F.count("*").alias("rows"), F.bit_xor("h").alias("mixed"), F.sum(F.col("h").cast("decimal(38,0)")).alias("summed"))


def write_changed(df: DataFrame, base: str, table: str, partition_by: tuple[str, ...] = (), compression: str = "zstd") -> int:
    """write_table(), but only of partitions whose content isn't the last one written; their number.

    The digests of what is published stand beside it, in _manifest, a row for each partition: one that fails between the table and its
    digests writes the partition again next time. ``df`` is worked out twice, so it should be written or kept. A table without partitions is one.
    """
    spark, at = df.sparkSession, join(base, "_manifest", table)
    before = [x for x in list_dirs(spark, at) if x.startswith("v")]
    now = content(df, partition_by)
    old = spark.read.schema(now.schema).parquet(join(at, before[-1])) if before else spark.createDataFrame([], now.schema)
    # A struct's nulls are equal to each other.
    new = now.join(old, ["part", "rows", "mixed", "summed"], "left_anti")
    new.unionByName(old.join(new.select("part"), "part", "left_anti")).coalesce(1).write.parquet(made := join(at, f"new-{uuid.uuid4().hex}"))
    changed = spark.read.schema(now.schema).parquet(made).join(old, ["part", "rows", "mixed", "summed"], "left_anti").select("part")
    n = changed.count()
    if n and partition_by:
        part = F.struct(*[F.col(c).cast("string").alias(c) for c in partition_by])
        write_table(df.withColumn("_part", part).join(changed.withColumnRenamed("part", "_part"), "_part", "left_semi").drop("_part"), base, table, partition_by, compression)
    elif n:
        write_table(df, base, table, compression=compression)
    fs, path = _fs(spark, made)
    fs.rename(path, _fs(spark, join(at, f"v{len(before) and int(before[-1][1:]) + 1:09d}"))[1])
    for x in before:
        remove(spark, join(at, x))
    return n


def write_quarantine(df: DataFrame, base: str, table: str, compression: str = "zstd") -> bool:
    """Rejected rows, if there are any."""
    if df.isEmpty():
        return False
    write_table(df, join(base, "_quarantine"), table, compression=compression)
    return True


def write_text(spark: SparkSession, text: str, uri: str) -> None:
    """A small text file, such as a report, by its exact name."""
    fs, path = _fs(spark, uri)
    out = fs.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_csv(df: DataFrame, uri: str) -> None:
    """A small result as one CSV file by its exact name."""
    import csv
    import io

    rows = io.StringIO()
    to = csv.writer(rows, lineterminator="\n")
    to.writerow(df.columns)
    to.writerows(df.select(*[F.col(c).cast("string") for c in df.columns]).toLocalIterator())
    write_text(df.sparkSession, rows.getvalue(), uri)


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a folder, if it is there."""
    fs, path = _fs(spark, uri)
    fs.delete(path, True)


def check_writable(spark: SparkSession, uri: str, label: str) -> None:
    """Write a marker and delete it again."""
    marker = join(uri, f"_preflight_{uuid.uuid4().hex}")
    try:
        write_text(spark, "ok", marker)
        fs, path = _fs(spark, marker)
        fs.delete(path, False)
    except Exception as e:
        raise PermissionError(f"{label}: {uri} can't be written: {e}") from e
