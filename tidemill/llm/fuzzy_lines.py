"""Fuzzy lines by MinHash: signatures of character shingles, bands, exact Jaccard, components.

A text's lines are what stands between line feeds. A line (without white space at its ends) is the set of
its character shingles: ``SIZE`` characters from each of its positions; a line of fewer is one shingle. Shingles are
named by 64-bit hashes (a rolling polynomial over code points, mixed), all of them in the signature and in the verification.
BANDS * ROWS minima, each by an order of its own, make a line's signature; lines that agree on all ROWS minima of a
band meet, and pairs of an exact Jaccard similarity of at least ``SIMILAR`` are linked. In each such bucket, every line
is first held against three of its lines (those first by three orders of the lines' names). Then all pairs that share a
bucket and aren't in one component yet are settled: in buckets of up to ``LARGE`` lines each is verified; of the lines of
larger ones, pairs that share a shingle of their prefixes (``set_pairs``), which no pair that reaches the similarity can
fail to do. Parities of their sets rule out most unlike pairs before their texts are sent, and none that is alike. Components of links are found by rounds of stars, and of each component the first line (by doc_id, then
place; rows without a doc_id last) is kept.

Two lines of a similarity of 0.8 share a band with odds of 98.5 %; of those that do, no link is missed.

Signatures and sets are made by Arrow batches and numpy: a native form that takes every position needs 1073 CPU seconds a
GB where 400 are allowed (see the README). The rest is DataFrame operations.

Lines of white space alone are kept and are no part of this. Null texts have no lines.
Repeated rows of one doc_id keep the same lines. Lines are named, and gathered, by their XXH64: among
10**9 distinct lines the odds that any two share one are 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import set_pairs
from tidemill.llm.common import components, passing, slices, table, texts
from tidemill.llm.set_pairs import BASE, Put
from tidemill.llm.set_pairs import mixed as _mixed

SIZE = 9
BANDS, ROWS = 8, 4
SIMILAR = 0.8
#: A bucket of more lines goes by its lines' rare shingles.
LARGE = 32
#: Characters that are hashed at once.
BLOCK = 1 << 17
#: Words of 64 bits of a line's parities.
WORDS = 16


def _rolled(codes: np.ndarray) -> np.ndarray:
    """A hash of the SIZE codes from each position on."""
    power, h, done = np.uint64(BASE), codes.astype(np.uint64), 1
    base = np.uint64(BASE)
    first = h
    for bit in bin(SIZE)[3:]:
        h, done = h[:-done] * power + h[done:], 2 * done
        power = power * power
        if bit == "1":
            h, done = h[:-1] * base + first[done:], done + 1
            power = power * base
    return _mixed(h)


def _codes(line: bytes) -> np.ndarray:
    """The code points of a line; one of fewer than SIZE is filled up."""
    found = np.frombuffer(line.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return found if len(found) >= SIZE else np.concatenate([found, np.zeros(SIZE - len(found), np.uint32)])


def shingle_set(line: bytes) -> np.ndarray:
    """The names of a line's shingles, distinct and ascending."""
    with np.errstate(over="ignore"):
        return np.unique(_rolled(_codes(line.strip(b" \t\r"))).view(np.int64))


def shingle_sets(lines: list[bytes]) -> list[np.ndarray]:
    """shingle_set() of each line, hashed BLOCK characters or one line at once."""
    out: list[np.ndarray] = []
    waiting: list[np.ndarray] = []

    def make() -> None:
        with np.errstate(over="ignore"):
            h = _rolled(np.concatenate(waiting)).view(np.int64)
        start = 0
        for codes in waiting:
            found = h[start : start + len(codes) - SIZE + 1]  # shingles that reach into the next line are none
            found.sort()
            again = found[1:] == found[:-1]
            out.append(found[np.concatenate([[True], ~again])] if again.any() else found)
            start += len(codes)
        waiting.clear()

    size = 0
    for line in lines:
        codes = _codes(line.strip(b" \t\r"))
        if waiting and size + len(codes) > BLOCK:
            make()
            size = 0
        waiting.append(codes)
        size += len(codes)
    if waiting:
        make()
    return out


_TURNS = (np.arange(BANDS * ROWS, dtype=np.uint32) << np.uint32(32 - (BANDS * ROWS - 1).bit_length())).astype(np.uint32)


def _minima(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each line, the least of its hashes by each order: one hash, its first bits turned in each of their ways.

    A minimum's shingles are those of one part of the hashes' range, or of the part beside it if that one is empty.
    """
    return np.stack([np.minimum.reduceat(h ^ t, starts) for t in _TURNS], axis=1)


def band_keys(lines: list[bytes]) -> np.ndarray:
    """(lines, BANDS): the keys of each line's bands."""
    with np.errstate(over="ignore"):
        least = np.zeros((len(lines), BANDS * ROWS), np.uint32)
        waiting: list[np.ndarray] = []
        size, first = 0, 0

        def out(upto: int) -> None:
            if waiting:
                h = (_rolled(np.concatenate(waiting)) >> np.uint64(32)).astype(np.uint32)
                sizes = np.array([len(c) for c in waiting])
                starts = np.cumsum(sizes) - sizes
                inside = np.ones(len(h), bool)  # shingles that reach into the next line are none
                inside[(starts[1:, None] - np.arange(1, SIZE)).ravel()] = False
                least[first:upto] = _minima(h[inside], starts - (SIZE - 1) * np.arange(len(starts)))
                waiting.clear()

        for i, line in enumerate(lines):
            codes = _codes(line.strip(b" \t\r"))
            if size + len(codes) > BLOCK:
                out(i)
                size, first = 0, i
            if len(codes) > BLOCK:
                parts = [(_rolled(codes[a : a + BLOCK + SIZE - 1]) >> np.uint64(32)).astype(np.uint32) for a in range(0, len(codes) - SIZE + 1, BLOCK)]
                least[i] = np.min([_minima(h, np.array([0]))[0] for h in parts], axis=0)
                size, first = 0, i + 1
                continue
            waiting.append(codes)
            size += len(codes)
        out(len(lines))
        both = least.reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), both.shape[:2])
        for r in range(ROWS):
            key = _mixed(key * np.uint64(BASE) + both[:, :, r])
        return key.view(np.int64)


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line): each line that isn't blank."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode_outer(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "line"))
    return rows.where("trim(BOTH ' \\t\\r' FROM line) <> ''")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "line_no")


def _lines(text: bytes) -> list[bytes]:
    return [x for x in text.split(b"\n") if x.strip(b" \t\r")]


def signatures(docs: DataFrame) -> DataFrame:
    """(id, keys): the keys of each line's bands, once for each part of the input that has the line; no text is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = {xxhash.xxh64_intdigest(x, 42): x for t in texts(batch) for x in _lines(t)}
            keys = band_keys([*found.values()])
            ids = np.fromiter(found, np.uint64, len(found)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel()))], ["id", "keys"])

    return docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, "id long, keys array<long>")


def only_lines(docs: DataFrame, bits: Broadcast) -> DataFrame:
    """(id, text) of the lines whose id may be among those marked; a line may be there more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = {xxhash.xxh64_intdigest(x, 42): x for t in texts(batch) for x in _lines(t)}
            ids = np.fromiter(found, np.uint64, len(found)).view(np.int64)
            some = np.flatnonzero(set_pairs.has(bits, ids))
            lines = [*found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array([lines[i] for i in some], pa.binary()).cast(pa.string())], ["id", "text"])

    return docs.select(docs["text"].cast("string").alias("text")).mapInArrow(run, "id long, text string")


def repeated(keyed: DataFrame) -> DataFrame:
    """(key, id) of the keys of signatures() that stand there twice, and of few that don't.

    What is counted is a key alone; what is left goes through a filter of fixed size, so a line of no bucket is shuffled no more.
    """
    twice = keyed.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    bits = set_pairs.marked(twice, "key", set_pairs.REPEATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["keys"].flatten().to_numpy()
            stays = set_pairs.has(bits, keys)
            yield pa.RecordBatch.from_arrays([pa.array(keys[stays]), pa.array(np.repeat(batch["id"].to_numpy(), BANDS)[stays])], ["key", "id"])

    return keyed.mapInArrow(run, "key long, id long")


def buckets(bands: DataFrame, put: Put) -> DataFrame:
    """(key, id, few, n): the lines of each band's key that several have, with three of them; those first by three orders."""
    turns = [0, 0x5BD1E9955BD1E995, -0x61C8864680B583EB]
    firsts = [F.min(F.col("id").bitwiseXOR(F.lit(t))).alias(f"c{i}") for i, t in enumerate(turns)]
    few = bands.groupBy("key").agg(*firsts, F.max("id").alias("last"), F.count("*").alias("n")).where("c0 < last")
    few = put(few.select("key", F.array_distinct(F.array(*[F.col(f"c{i}").bitwiseXOR(F.lit(t)) for i, t in enumerate(turns)])).alias("few"), "n"), "few")
    return put(bands.join(few, "key"), "buckets")


def candidates(met: DataFrame) -> DataFrame:
    """Pairs (id, id2) of lines to verify: each line of a bucket with the bucket's three."""
    each = met.select("id", F.explode("few").alias("id2")).where("id <> id2")
    # Both lines may be among the three; then the pair is there once.
    return each.groupBy(F.least("id", "id2").alias("lo"), F.greatest("id", "id2").alias("hi")).agg(F.first("id").alias("id"), F.first("id2").alias("id2")).select("id", "id2")


def rest(met: DataFrame, pick: set_pairs.Pick, roots: DataFrame, similar: float, put: Put) -> DataFrame:
    """Pairs (id, id2) to verify of lines that share a bucket and aren't in one component of ``roots`` (id, component).

    All such pairs that can reach ``similar`` are there.
    """
    members = met.select("key", "id", "n").join(roots, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = put(members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key"), "mixed")
    met = put(members.join(mixed, "key"), "met")
    few = met.where(F.col("n") <= LARGE).drop("n").distinct()
    pairs = set_pairs.crossing(few, few, ["key"]).where("id < id2").select("id", "id2")
    large = met.where(F.col("n") > LARGE).drop("n")
    # A pair of two components has a line that isn't of its bucket's most frequent one: its shingles are those that matter.
    shares = large.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = shares.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main")).select("key", F.col("main.component").alias("main"))
    many = put(large.join(main, "key").groupBy("id", "component").agg(F.max((F.col("component") != F.col("main")).cast("int")).alias("minor")), "many")
    if many.isEmpty():
        return pairs.distinct()
    some = put(pick(set_pairs.marked(many, "id")).dropDuplicates(["id"]).join(many, "id"), "some")
    weights = set_pairs.weights_of(some, shingle_sets)
    asked = put(set_pairs.prefixes(some.where("minor = 1"), shingle_sets, similar, weights).select(F.explode("s").alias("s")).distinct(), "asked")
    firsts = put(set_pairs.prefixes(some, shingle_sets, similar, weights, set_pairs.marked(asked, "s")), "prefixes").join(many.drop("minor"), "id")
    close = set_pairs.crossed(set_pairs.exploded(firsts, "component"), similar, put)
    return pairs.union(close).select(F.least("id", "id2").alias("id"), F.greatest("id", "id2").alias("id2")).distinct()


def links(docs: DataFrame, similar: float, put: Put) -> DataFrame:
    """(id, component) of the lines that are linked to another."""
    with passing(docs.sparkSession) as meanwhile:
        met = buckets(meanwhile(repeated(meanwhile(signatures(docs), "keys")), "bands"), put)
    lines = put(only_lines(docs, set_pairs.marked(met, "id", set_pairs.REPEATS)).dropDuplicates(["id"]), "lines")
    pick, odd = partial(set_pairs.only, lines), put(set_pairs.with_parities(lines, shingle_sets, WORDS), "parities")
    near = partial(set_pairs.near, firsts=odd, similar=similar, words=WORDS)
    once = set_pairs.verified(near(candidates(met)), pick, shingle_sets, similar, put)
    roots = components(once.select(F.col("id").alias("a"), F.col("id2").alias("b"))).withColumnRenamed("node", "id")
    more = set_pairs.verified(near(rest(met, pick, roots, similar, put)), pick, shingle_sets, similar, put)
    if more.isEmpty():
        return roots
    edges = roots.union(more.select("id", "id2")).toDF("a", "b")
    return components(edges).withColumnRenamed("node", "id")


def fuzzy_lines(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """A row for each line that isn't blank: doc_id, line_no, line_id, component, kept, keep_doc_id, keep_line_no, n_lines.

    component is the smallest line_id that links reach, keep_* the place of the line that is
    kept for it, n_lines how many lines have it.
    """
    rows = line_rows(docs).select("doc_id", "line_no", F.xxhash64("line").alias("line_id"))
    with passing(docs.sparkSession) as put:
        roots = links(docs, similar, put)
        places = rows.groupBy(F.col("line_id").alias("id")).agg(F.min(_place()).alias("first"), F.count("*").alias("n"))
        # Lines that stand once and are like no other keep themselves; the rest is looked up below.
        some = places.join(roots, "id", "left").where("n > 1 OR component IS NOT NULL")
        named = put(some.withColumn("component", F.coalesce("component", "id")), "named")
        first = put(named.groupBy("component").agg(F.min("first").alias("keep"), F.sum("n").alias("n_lines")), "first")
        keeps = table(named.select("id", "component").join(first, "component").select(F.col("id").alias("line_id"), "component", "keep", "n_lines"), "keeps")
    found = rows.join(keeps, "line_id", "left")
    keep = F.coalesce("keep", _place())
    return found.select(
        "doc_id",
        F.col("line_no").cast("long").alias("line_no"),
        "line_id",
        F.coalesce("component", "line_id").alias("component"),
        _place().eqNullSafe(keep).alias("kept"),
        keep["doc_id"].alias("keep_doc_id"),
        keep["line_no"].cast("long").alias("keep_line_no"),
        F.coalesce("n_lines", F.lit(1)).alias("n_lines"),
    )


def without_fuzzy_lines(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``docs`` with the lines that aren't kept taken out of ``text``; rows and columns stay.

    What is gathered for a row is the numbers of its own document's lines.
    """
    gone = fuzzy_lines(docs, similar).where("NOT kept").groupBy(F.col("doc_id").alias("__gone_id")).agg(F.collect_set("line_no").alias("__gone"))
    both = docs.join(table(gone, "gone"), docs["doc_id"].cast("long").eqNullSafe(F.col("__gone_id")), "left")
    lines = F.split(docs["text"].cast("string"), "\n")
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.col("__gone"), i.cast("long")))
    text = F.when(F.col("__gone").isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    return both.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
