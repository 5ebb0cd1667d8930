"""Near duplicates by SimHash, found through tables of distances to pivots.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; shingles are three words joined by a
space, repeats included (fewer words: all of them; none: the fingerprint is zero). A bit of
a fingerprint is 1 if it is set in over half of the shingles' XXH64 (seed 42). Two
fingerprints are linked if at most ``WITHIN`` bits differ, and a class is what links reach.

The pivots are reference fingerprints: zero, the 32 masks of two adjacent bits, and seven
spread ones. Their Hamming distances d to each distinct fingerprint are
computed once. For a mask S, (d(x, 0) - d(x, S) + 2) / 2 is how many of its two bits x has;
fingerprints at most two bits apart can differ in at most two of these 32 coordinates.
So, with the coordinates in five groups, linked fingerprints agree in three whole groups,
and a join on each choice of three groups meets every linked pair. Pairs that it brings
together are discarded if any coordinate to the spread pivots differs by more than
``WITHIN`` (the triangle inequality), and the survivors are verified by their bits.

``one_of_each`` can also link texts whose sets of shingles of ``words`` words have an exact Jaccard similarity of
``similar`` or more, which two bits mostly don't. These are found by their prefixes and verified exactly (``set_pairs``).

Copies share one fingerprint and are one row of the table. Null texts are empty; rows without
a doc_id never name a class while another row of it has one. Columns other than doc_id and
text don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import set_pairs
from tidemill.llm.common import append, components, holds, passing, slices, table, texts

SEED = 42
WITHIN = 2
GROUPS = 5
#: Times that texts are held against a few of other classes before all pairs of what is apart.
TURNS = 2
#: Bytes of text that are hashed at once, and the most that a word has whose name is a polynomial.
BLOCK, LONG = 1 << 18, 64
#: Reference fingerprints besides zero and the masks of two bits: multiples of the golden ratio.
SPREAD = [(i * 0x9E3779B97F4A7C15) % 2**64 for i in range(1, 8)]

_BITS = np.array([[v >> b & 1 for b in range(8)] for v in range(256)], np.int64)


def fingerprint(text: bytes) -> int:
    """The fingerprint of one text, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False)) if len(words) > 2 else [b" ".join(words)]
    n = max(1, len(words) - 2)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n).view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(hashes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``df`` with the fingerprint of each text as a long (its bits as a signed number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("fingerprints")
        for batch in slices(batches, text):
            found = np.array([fingerprint(x) for x in texts(batch, text)], np.uint64)
            yield append(batch, **{name: pa.array(found.view(np.int64))})

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))


def _signed(x: int) -> Column:
    return F.lit(x - 2**64 if x >= 2**63 else x)


def _to(pivot: int, fp: Column) -> Column:
    return F.bit_count(fp.bitwiseXOR(_signed(pivot)))


def pivot_table(prints: DataFrame) -> DataFrame:
    """(fp, groups, spread): the coordinates of each fingerprint ``fp``.

    groups: an array of GROUPS numbers, each the coordinates of some masks written in
    base 3; spread: an array of the distances to SPREAD.
    """
    fp = F.col("fp")
    zero = _to(0, fp)
    weights = [((zero - _to(3 << 2 * i, fp) + 2) / 2).cast("long") for i in range(32)]
    groups = []
    for part in np.array_split(np.arange(32), GROUPS):
        total = F.lit(0).cast("long")
        for i in part:
            total = total * 3 + weights[i]
        groups.append(total)
    return prints.select("fp", F.array(*groups).alias("groups"), F.array(*[_to(p, fp).cast("byte") for p in SPREAD]).alias("spread"))


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a < b) of distinct fingerprints with at most WITHIN bits between them."""
    coordinates = table(pivot_table(prints), "pivots")
    choices = list(combinations(range(GROUPS), GROUPS - WITHIN))
    size = 3**7
    keys = []
    for i, choice in enumerate(choices):
        key = F.lit(i).cast("long")
        for g in choice:
            key = key * size + F.col("groups")[g]
        keys.append(key)
    keyed = coordinates.select(F.explode(F.array(*keys)).alias("key"), "fp", "spread")
    other = keyed.select("key", F.col("fp").alias("fp2"), F.col("spread").alias("spread2"))
    met = keyed.join(other, "key").where("fp < fp2")
    for i in range(len(SPREAD)):
        met = met.where(F.abs(F.col("spread")[i] - F.col("spread2")[i]) <= WITHIN)
    close = met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= WITHIN)
    return close.select(F.col("fp").alias("a"), F.col("fp2").alias("b")).distinct()


def _powers(base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.full(BLOCK - 1, base, np.uint64)]).cumprod(dtype=np.uint64)


_POWERS, _INVERSE = _powers(set_pairs.BASE), _powers(pow(set_pairs.BASE, -1, 2**64))
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_NEXT = re.compile(rb"[\t-\r ]").search


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a lower-cased text starts, and its 64-bit name: a polynomial of its bytes, mixed; of words over LONG bytes their XXH64."""
    places, names, at = [], [], 0
    while at < len(text):
        codes = np.frombuffer(text, np.uint8, min(BLOCK, len(text) - at), at)
        space = _SPACE[codes]
        if at + len(codes) < len(text):  # the block ends with a word
            cut = np.flatnonzero(space)
            if not len(cut):
                end = m.start() if (m := _NEXT(text, at)) else len(text)
                places.append(np.array([at], np.int64))
                names.append(np.array([xxhash.xxh64_intdigest(text[at:end], SEED)], np.uint64))
                at = end
                continue
            codes, space = codes[: cut[-1] + 1], space[: cut[-1] + 1]
        edges = np.flatnonzero(np.diff(~space, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(codes)], out=sums[1:])
        own = set_pairs.mixed((sums[ends] - sums[starts]) * _INVERSE[starts])
        for i in np.flatnonzero(ends - starts > LONG):
            own[i] = xxhash.xxh64_intdigest(text[at + starts[i] : at + ends[i]], SEED)
        places.append(starts + at)
        names.append(own)
        at += len(codes)
    return np.concatenate([np.zeros(0, np.int64), *places]), np.concatenate([np.zeros(0, np.uint64), *names])


def _joined(h: np.ndarray, size: int) -> np.ndarray:
    """The names of all ``size`` words in a row."""
    out = h[: len(h) - size + 1] if size else h
    for i in range(1, size):
        out = out * np.uint64(set_pairs.BASE) + h[i : len(h) - size + 1 + i]
    return set_pairs.mixed(out + np.uint64(size)).view(np.int64)


def shingle_sets(found: list[bytes], words: int) -> list[np.ndarray]:
    """64-bit names of each text's distinct shingles, ascending: a polynomial of their words' names, mixed. Fewer words are one shingle."""
    with np.errstate(over="ignore"):
        starts, h = word_hashes(b"\n".join(found).lower())
        ends = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in found], dtype=np.int64)).tolist()
        every = _joined(h, words) if len(h) >= words else None
        out = []
        for a, b in zip([0, *ends], ends, strict=False):
            if b - a < words:
                out.append(_joined(h[a:b], b - a))
                continue
            own = np.sort(every[a : b - words + 1])  # shingles that reach into the next text are none
            again = own[1:] == own[:-1]
            out.append(own[np.concatenate([[True], ~again])] if again.any() else own)
        return out


def shingle_set(text: bytes, words: int) -> np.ndarray:
    return shingle_sets([text], words)[0]


def alike(rows: DataFrame, named: DataFrame, edges: DataFrame, words: int, similar: float) -> DataFrame:
    """Pairs (a, b) of fingerprints of texts that have ``similar``; together with ``edges`` they connect all such pairs.

    rows: (id, text), a text named by its XXH64; named: (id, fp). Each text is first held against one other, that
    which shares most of its prefix among those with the smallest names; then up to TURNS times against a few texts of
    other classes, which joins most of a group of near copies; then all that is still apart is searched.
    """
    sets, pick = partial(shingle_sets, words=words), partial(set_pairs.only, rows)
    names = named.distinct()

    def as_edges(found: DataFrame) -> DataFrame:
        one, two = names.select("id", F.col("fp").alias("a")), names.select(F.col("id").alias("id2"), F.col("fp").alias("b"))
        return found.join(one, "id").join(two, "id2").where("a <> b").select("a", "b").distinct()

    with passing(rows.sparkSession) as put:
        weights = set_pairs.weights_of(rows, sets)
        with passing(rows.sparkSession) as meanwhile:
            every = meanwhile(set_pairs.prefixes(rows, sets, similar, weights, parity=True), "prefixes")
            firsts = put(set_pairs.repeated(every).dropDuplicates(["id"]), "repeated")
        each = set_pairs.exploded(firsts)
        centers = put(each.groupBy("s").agg(F.min("id").alias("center"), F.max("id").alias("last")).where("center < last").select("s", "center"), "centers")
        shares = each.join(centers, "s").where("id <> center").groupBy("id", "center").agg(F.count("*").alias("n"))
        best = shares.groupBy("id").agg(F.max(F.struct("n", "center")).alias("best")).select("id", F.col("best.center").alias("id2"))
        few = set_pairs.near(best, firsts, similar)
        once = table(as_edges(set_pairs.verified(few, pick, sets, similar, put)), "alike")
        each = None
        for turn in range(TURNS + 1):
            roots = components(edges.union(once)).withColumnRenamed("node", "fp")
            of = put(names.join(roots, "fp", "left").select("id", F.coalesce("component", "fp").alias("component")), "components")
            # Components only grow: what no two of them share now, none will share later.
            each = set_pairs.shared_by_several(set_pairs.exploded(firsts).join(of, "id"), put).drop("component") if each is None else each
            if turn == TURNS:
                break
            few = set_pairs.near(put(set_pairs.partners(each.join(of, "id"), similar, turn), "partners"), firsts, similar)
            found = table(as_edges(set_pairs.verified(few, pick, sets, similar, put)), "alike")
            if found.isEmpty():
                break
            once = once.union(found)
        apart = set_pairs.crossed(each.join(of, "id"), similar, put).distinct()
        more = set_pairs.near(apart, firsts, similar)
        return once.union(table(as_edges(set_pairs.verified(more, pick, sets, similar, put)), "alike"))


def classes(prints: DataFrame, more: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """For rows (doc_id, fp): each fp with component, component_id, links and copies.

    component: the smallest fp of its class (as a signed number); component_id: the smallest doc_id of its class; copies: the rows that have it; links:
    the rows, besides one's own, that are linked with a row that has it. ``more`` makes further links, which
    count for the classes alone, from those of at most WITHIN bits.
    """
    single = table(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "prints")
    edges = table(links(single), "links")
    roots = components(edges.union(more(edges)) if more else edges)
    both = edges.union(edges.select("b", "a"))
    sums = both.join(single.select(F.col("fp").alias("b"), "copies"), "b").groupBy(F.col("a").alias("fp")).agg(F.sum("copies").alias("near"))
    named = table(single.join(roots.withColumnRenamed("node", "fp"), "fp", "left").join(sums, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "named")
    least = table(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    out = named.join(least, "component").select("fp", "component", "component_id", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("links"), "copies")
    return table(out, "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, links."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = table(with_fingerprints(rows).select("doc_id", "fp"), "fps")
    found = prints.join(classes(prints), "fp")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "links")


def one_of_each(docs: DataFrame, words: int | None = None, similar: float = 0.8) -> DataFrame:
    """The rows of ``docs`` of which one stays for each class, with its columns.

    With ``words``, texts whose shingles of so many words have a Jaccard similarity of ``similar`` are linked as well.

    It is the row with the class's smallest doc_id, and of rows with that doc_id the one
    whose text has the smallest XXH64 (repeated rows all stay: exact copies are not this
    operator's work). Where no row of a class has a doc_id, the smallest XXH64 decides.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"))
    prints = table(with_fingerprints(rows).select("doc_id", "fp", F.xxhash64("text").alias("h")), "fps")
    more = None
    if words:
        whole, ids = rows.select(F.xxhash64("text").alias("id"), "text"), prints.select(F.col("h").alias("id"), "fp")

        def more(edges: DataFrame) -> DataFrame:
            return alike(whole, ids, edges, words, similar)

    named = prints.join(classes(prints, more), "fp")
    ends = named.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = table(ends.groupBy("component").agg(F.first("component_id").alias("__stay_id"), F.min("h").alias("__stay_h")), "stays")
    return docs.join(stays, docs["doc_id"].cast("long").eqNullSafe(stays["__stay_id"]) & (F.xxhash64(text) == stays["__stay_h"]), "left_semi")


def op9_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
