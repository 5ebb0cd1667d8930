"""Exact duplicates by a stateful stream.

The stream's keyed state is on disk (RocksDB) and never expires. For each digest and
length of a text it retains the stable identifier (the largest doc_id) and the content
locator (file and row) of the row that stays, and how many rows had it. On hits the full
bytes are checked: rows whose digest was met before are compared with the text at the
locator, and rows that only share a digest are told apart by their texts. Everything
here is DataFrame operations. ``exact_duplicates`` takes one table with a state of its own; ``arrived`` keeps the
state in a folder that is named, so documents that come later are held against all that came before.

Null counts as the empty text. Of equal texts the row with the largest doc_id stays
(rows without a doc_id yield to others); of repeated rows, the one whose locator is
largest. An empty table gives no rows. Columns other than doc_id and text don't matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.llm.common import remove, scratch, table

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Session settings while the stream runs.
STATE = {
    PROVIDER: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "false",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition takes megabytes in advance
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def from_files(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows have places in files, else a table of them in the shared folder."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"]).schema  # noqa: B018
        return docs
    except AnalysisException:
        return table(docs, "landed")


def located(docs: DataFrame, columns: list[str], name: str = "at") -> DataFrame:
    """Columns of from_files(), and ``name``, the content locator: a row's file and its place there."""
    meta = docs.metadataColumn("_metadata")
    return docs.select(*[docs[c] for c in columns], F.struct(meta["file_path"].alias("file"), meta["row_index"].alias("row")).alias(name))


def _state(spark: SparkSession, schema: StructType, path: str, where: str) -> DataFrame:
    """Run the stream with its checkpoint at ``where`` over what is new at ``path``, and read back its state."""
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)
        stream = spark.readStream.schema(schema).parquet(path)
        kept = stream.groupBy("digest", "length").agg(F.max(F.struct("doc_id", "at")).alias("stays"), F.count("*").alias("n"))
        # Each batch's changes go nowhere; what matters is the state, read below.
        kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", where).trigger(availableNow=True).start().awaitTermination()
        state = spark.read.format("statestore").load(where)
        groups = state.select("key.digest", "key.length", F.col("value").alias("v"))
        names = groups.schema["v"].dataType.names
        return table(groups.select("digest", "length", F.col(f"v.`{names[0]}`").alias("stays"), F.col(f"v.`{names[1]}`").alias("n")), "groups")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _records(docs: DataFrame, digest: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Of rows with places in files: (doc_id, text, at, digest, length), and the same without texts (doc_id, at, digest, length, sha)."""
    rows = located(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "at")
    rows = rows.withColumns({"digest": digest(F.col("text")), "length": F.octet_length("text").cast("long")})
    sha = F.lit(None).cast("binary") if digest is sha256 else sha256(F.col("text"))
    return rows, rows.select("doc_id", "at", "digest", "length", sha.alias("sha"))


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row for each row of ``docs``: doc_id, at, text_sha256, keep_id, group_size, kept."""
    spark = docs.sparkSession
    rows, found = _records(from_files(docs), digest)
    found.write.parquet(path := scratch(spark, "records"))
    records = spark.read.schema(found.schema).parquet(path)
    if records.isEmpty():
        return _named(records.withColumns({"stays": F.struct("doc_id", "at"), "n": F.lit(0).cast("long")}))
    groups = _state(spark, records.schema, path, checkpoint := scratch(spark, "stream"))
    remove(spark, checkpoint)
    return _resolved(rows, records, records, groups)


def arrived(docs: DataFrame, state: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """As exact_duplicates() for the rows of ``docs``, held against all that arrived at ``state`` before as well.

    ``state`` is a folder of the caller's in shared storage, the same for each arrival: it has the stream's checkpoint,
    the records (digests, identifiers, locators) and the contents that locators name. The stream reads the new records alone.
    keep_id, group_size and kept are those after this arrival; rows of earlier ones that yield to a new row are told by
    its keep_id. An arrival that failed after it landed is made good by the next one: its records are still new to the stream.
    """
    spark = docs.sparkSession
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).write.parquet(own := f"{state}/content/{uuid.uuid4().hex}")
    _, found = _records(spark.read.schema("doc_id long, text string").parquet(own), digest)
    found.write.parquet(path := f"{state}/records/{own.rpartition('/')[2]}")
    new, records = (spark.read.schema(found.schema).parquet(x) for x in (path, f"{state}/records/*"))
    if new.isEmpty():
        return _named(new.withColumns({"stays": F.struct("doc_id", "at"), "n": F.lit(0).cast("long")}))
    groups = _state(spark, found.schema, f"{state}/records/*", f"{state}/stream").join(new.select("digest", "length").distinct(), ["digest", "length"], "left_semi")
    content = located(spark.read.schema("doc_id long, text string").parquet(f"{state}/content/*"), ["text"]).withColumn("text", F.coalesce("text", F.lit("")))
    return _resolved(content.join(records.drop("sha"), "at"), records, new, table(groups, "touched"))


def _resolved(rows: DataFrame, records: DataFrame, new: DataFrame, groups: DataFrame) -> DataFrame:
    """The result for the ``new`` of ``records``: by their groups, where full bytes confirm those; else by their texts."""
    key = ["digest", "length"]
    # Full bytes on hits: rows of a digest met more than once, beside the row that stays.
    met = groups.where("n > 1").select(*key, "stays")
    hits = table(rows.join(met, key).withColumn("first", F.struct("doc_id", "at").eqNullSafe(F.col("stays"))), "hits")
    held = hits.where("first").select(*key, F.col("text").alias("held"))
    other = hits.where("NOT first").join(held, key).where("text <> held").select(*key)
    # The distinct keys come from a table: above the join they would keep a hot digest's rows in one task.
    mixed = table(table(other, "unlike").distinct(), "mixed")
    out = new.join(groups, key)
    if mixed.isEmpty():
        return _named(out)
    # Digests of more than one text: there the text itself is the key.
    some = hits.join(mixed, key, "left_semi")
    true = some.groupBy(*key, "text").agg(F.max(F.struct("doc_id", "at")).alias("stays"), F.count("*").alias("n"))
    mine = some.join(new.select("at"), "at", "left_semi")
    again = mine.select("doc_id", "at", *key, "text", sha256(F.col("text")).alias("sha")).join(true, [*key, "text"]).drop("text")
    return _named(out.join(mixed, key, "left_anti").unionByName(again.select(out.columns)))


def _named(df: DataFrame) -> DataFrame:
    stays = F.col("stays")
    return df.select(
        "doc_id",
        "at",
        F.lower(F.hex(F.coalesce("sha", "digest"))).alias("text_sha256"),
        stays["doc_id"].alias("keep_id"),
        F.col("n").alias("group_size"),
        F.struct("doc_id", "at").eqNullSafe(stays).alias("kept"),
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns."""
    docs = from_files(docs)  # once: both sides of the join must name the same places
    rows = located(docs, docs.columns, "__content_at")
    at = exact_duplicates(docs).where("kept").select(F.col("at").alias("__stays_at"))
    return rows.join(at, F.col("__content_at") == F.col("__stays_at"), "left_semi").drop("__content_at")


def op10_streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
