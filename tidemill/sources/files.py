"""Reading the raw export and published tables, from any Hadoop path."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.exprs import na_to_null, true


def join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *(p.strip("/") for p in parts)])


def _fs(spark: SparkSession, uri: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _fs(spark, uri)
    return fs.exists(path)


def list_dirs(spark: SparkSession, uri: str) -> list[str]:
    """The names of the folders in a folder, sorted."""
    fs, path = _fs(spark, uri)
    return sorted(x.getPath().getName() for x in fs.listStatus(path) if x.isDirectory()) if fs.exists(path) else []


def check_readable(spark: SparkSession, uri: str, label: str) -> None:
    fs, path = _fs(spark, uri)
    if not fs.exists(path):
        raise FileNotFoundError(f"{label}: {uri} is not there")
    if not list(fs.listStatus(path)):
        raise FileNotFoundError(f"{label}: {uri} is empty")


def lineage(df: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """Where a row came from and when: _source_uri, _ingested_at, _run_id."""
    return df.withColumns({"_source_uri": F.col("_metadata.file_path"), "_ingested_at": F.lit(at).cast("timestamp_ntz"), "_run_id": F.lit(run_id)})


#: Parts of files up to which their places are sent to every task: a hundred bytes each.
FEW_FILES = 50_000


def json_objects(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files that hold one JSON array of objects each: a row (value, _source_uri, _ordinal) for each object, as text, with its place in its file.

    A file isn't read as one value: it is cut after every "}", so that a large one is read in parts by many tasks, and an object is what is between
    two cuts. What was before a part is known from the parts' counts, a row each. Where one cut isn't one object (objects within objects, or
    braces, backslashes or a lone quote in texts), the file's pieces are put together in their order, by how deep in braces and whether in a text
    each ends; that sorts such a file in one task, which doesn't hold it. Elements that are no objects are passed over.
    """
    raw = spark.read.option("lineSep", "}").text(paths).select("value", F.col("_metadata.file_path").alias("_source_uri"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    count = lambda x, c: F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))
    braces, opens = count(F.col("value"), "{"), F.col("value").contains("{")
    odd = (braces > 1) | F.col("value").contains("\\") | (count(F.col("value"), '"') % 2 != 0)
    parts = raw.groupBy("_source_uri", "_block").agg(F.min("_at").alias("_first"), F.count_if(opens).alias("_objects"), F.count_if(odd | (~opens & F.trim("value").rlike("[^\\[\\],\\s]"))).alias("_odd"))
    of = Window.partitionBy("_source_uri")
    parts = parts.withColumns({"_before": F.sum("_objects").over(of.orderBy("_block")) - F.col("_objects"), "_odd": F.sum("_odd").over(of) > 0}).drop("_objects")
    few, every = len(raw.inputFiles()) <= FEW_FILES, True
    if few:  # counted once, and no second look at files of which none is odd
        rows = parts.collect()
        every = any(r["_odd"] for r in rows)
        parts = F.broadcast(spark.createDataFrame(rows, parts.schema))
    met = raw.join(parts, ["_source_uri", "_block"])
    plain = met.where(~F.col("_odd") & opens).select(F.concat(F.ltrim("value", F.lit("[, \n\r\t")), F.lit("}")).alias("value"), "_source_uri", (F.col("_before") + F.col("_at") - F.col("_first")).cast("int").alias("_ordinal"))
    if not every:
        return plain
    # Pieces in order: quotes before them say whether they begin in a text, braces outside of texts how deep they end.
    w = Window.partitionBy("_source_uri").orderBy("_block", "_at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = met.where("_odd").select("_source_uri", "_block", "_at", "value", bare.alias("_bare")).withColumn("_quotes", count(F.col("_bare"), '"')).withColumn("_inside", F.sum("_quotes").over(upto) % 2 == 1)
    starts_inside = true(F.lag("_inside").over(w))
    outside = F.regexp_replace(F.concat(F.when(starts_inside, F.lit('"')).otherwise(F.lit("")), F.col("_bare")), r'"[^"]*("|$)', "")
    pieces = pieces.withColumn("_depth", count(outside, "{") - F.when(F.col("_inside"), 0).otherwise(1))
    pieces = pieces.withColumn("_ends", (F.sum("_depth").over(upto) == 0) & ~F.col("_inside"))
    pieces = pieces.withColumn("_ordinal", (F.sum(F.col("_ends").cast("long")).over(upto) - F.col("_ends").cast("long")).cast("int"))
    texts = pieces.groupBy("_source_uri", "_ordinal").agg(F.bool_or("_ends").alias("_whole"), F.array_sort(F.collect_list(F.struct("_block", "_at", "value"))).alias("p")).where("_whole")
    joined = F.concat(F.array_join(F.transform("p", lambda x: x["value"]), "}"), F.lit("}"))
    return plain.unionByName(texts.select(F.regexp_replace(joined, r"^[^{]*", "").alias("value"), "_source_uri", "_ordinal"))


def read_records(spark: SparkSession, glob: str, run_id: str, at: datetime, participants=None) -> DataFrame:
    """JSON files that hold one array each, a row for each record.

    ``record`` has every field as text by name, so that none is lost, and ``_ordinal`` is the
    record's place in its file, which is what "first seen" means here. Participants are
    folders, and choosing some prunes what is read.
    """
    paths = [glob.replace("*", p) for p in participants] if participants else [glob]
    found = json_objects(spark, paths)
    record = F.from_json("value", "map<string,string>").alias("record")
    folder = F.element_at(F.split("_source_uri", "/"), -2).alias("_source_participant_dir")
    return found.select("_ordinal", record, folder, "_source_uri", F.lit(at).cast("timestamp_ntz").alias("_ingested_at"), F.lit(run_id).alias("_run_id"))


def fields(records: DataFrame, names: list[str]) -> DataFrame:
    """The named fields of ``record`` as text columns, before the other columns."""
    return records.select(*[F.col("record")[n].alias(n) for n in names], *[c for c in records.columns if c != "record"])


def field_names(records: DataFrame) -> list[str]:
    """Every field that some record has."""
    return sorted(r[0] for r in records.select(F.explode(F.map_keys("record"))).distinct().collect())


def field_types(records: DataFrame) -> DataFrame:
    """(field, n, type): every field that some record has, how many have a value there, and what all these values are: long, double, boolean, timestamp or string."""
    each = records.select(F.explode("record").alias("field", "v"))
    all_ = lambda kind: F.bool_and(F.col("v").try_cast(kind).isNotNull() | F.col("v").isNull())
    kinds = reduce(lambda rest, kind: F.when(all_(kind), kind).otherwise(rest), ("timestamp", "boolean", "double", "long"), F.lit("string"))
    return each.groupBy("field").agg(F.count("v").alias("n"), kinds.alias("type"))


SLEEP = (
    "array<struct<participant_id: string, date: string, sleep_onset: string, sleep_end: string, efficiency_pct: string, restlessness: string, "
    "stages: array<struct<stage: string, start_time: string, end_time: string, duration_min: string>>>>"
)


def read_sleep(spark: SparkSession, glob: str, run_id: str, at: datetime, participants=None) -> tuple[DataFrame, DataFrame]:
    """Sleep sessions, and their stages by place; the key is participant, day and onset (null if one is)."""
    paths = [glob.replace("*", p) for p in participants] if participants else [glob]
    files = lineage(spark.read.text(paths, wholetext=True), run_id, at)
    found = files.select(F.explode(F.from_json("value", SLEEP)).alias("s"), "_source_uri", "_ingested_at", "_run_id")
    key = F.concat(F.col("s.participant_id"), F.lit("|"), F.col("s.date"), F.lit("|"), F.col("s.sleep_onset"))
    meta = ["_source_uri", "_ingested_at", "_run_id"]
    head = ["participant_id", "date", "sleep_onset", "sleep_end", "efficiency_pct", "restlessness"]
    count = F.coalesce(F.size("s.stages"), F.lit(0))
    sessions = found.select(key.alias("session_key"), *[F.col(f"s.{c}").alias(c) for c in head], F.greatest(count, F.lit(0)).cast("long").alias("n_stages"), *meta)
    each = found.select(key.alias("session_key"), F.col("s.participant_id").alias("participant_id"), F.col("s.date").alias("date"), F.posexplode("s.stages").alias("stage_idx", "g"), *meta)
    return sessions, each.select("session_key", "participant_id", "date", "stage_idx", "g.*", *meta)


def read_csv(spark: SparkSession, path: str, columns: list[str], na_tokens: bool = True, placed: bool = False) -> DataFrame:
    """CSV with a header, every column as text; cells without a value are null.

    With ``na_tokens`` the usual words for "no value" are null too, else only blank cells. With ``placed``, _block and
    _ordinal say where in its file a row stands: they order a file's rows, though it is read in parts.
    """
    df = spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in columns), enforceSchema=False)
    if placed:
        df = df.withColumns({"_block": F.col("_metadata.file_block_start"), "_ordinal": F.monotonically_increasing_id()})
    return df.withColumns({c: na_to_null(F.col(c)) for c in columns}) if na_tokens else df


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A published table with its partition columns; filters on those prune folders."""
    return spark.read.option("basePath", join(base, table)).parquet(join(base, table))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(folder, name, bytes) of every file under ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("name"), F.col("length").alias("bytes"))


def completeness(files: DataFrame, names: list[str]) -> DataFrame:
    """A row for each folder: the bytes of each expected file, and whether one is missing."""
    wide = files.groupBy("folder").pivot("name", names).sum("bytes")
    return wide.withColumn("is_incomplete", F.greatest(*[F.col(f"`{n}`").isNull() for n in names]))


def register(frames: dict[str, DataFrame], dates: tuple[str, ...] = ("date", "calibration_date", "week_start", "week_end")) -> None:
    """Each frame as a view of its name, with the date columns as dates."""
    for name, df in frames.items():
        casts = {c: F.col(c).cast("date") for c in df.columns if c in dates}
        df.withColumns(casts).createOrReplaceTempView(name)
