"""Pairs of texts whose sets of shingles are alike: exact verification, and an exact search by prefixes.

Texts are rows (id, text); a function gives the sets of some texts, each as distinct 64-bit hashes, ascending. Everything that
is broadcast or reaches the driver has a size that is set here and doesn't grow: a histogram of ``PARTS`` counts and
sets of ``MARKS`` or ``REPEATS`` bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import slices, texts

#: Parts of the hashes' range in which shingles are counted, to take those of common passages last.
PARTS = 1 << 18
#: Hashes by their last bits, to leave out early what no join will want.
MARKS = 1 << 22
#: The same for shingles that stand in two texts or more (8 MB). Of very many such shingles it keeps some that stand in one; results are the same.
REPEATS = 1 << 26
#: Words of 64 bits of a text's parities.
WORDS = 32
#: So many texts of other components a text is held against at once, before all pairs that are left.
PARTNERS = 16
#: So many partners of one text are compared in one group; of more, the text goes to several groups.
GROUP = 256

#: Bytes of text whose sets are made at once.
AT_ONCE = 1 << 20

FIRSTS = "id long, size int, short int, s array<long>, at array<int>"
Sets = Callable[[list[bytes]], list[np.ndarray]]
#: Gives the rows (id, text) whose id may be among those marked.
Pick = Callable[[Broadcast], DataFrame]
Put = Callable[[DataFrame, str], DataFrame]


#: Odd multipliers: of polynomials over hashes, and of mixing.
BASE, MIX = 0x9E3779B97F4A7C15, (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits spread; different ones stay different."""
    for m in MIX:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def marked(df: DataFrame, name: str, marks: int = MARKS) -> Broadcast:
    """Which of so many last bits (a power of two) the hashes of a column have, sent to the workers as bits.

    They are put together 64 at a time on the way, so the driver gets at most ``marks`` / 64 rows.
    """
    last = F.col(name).bitwiseAND(F.lit(marks - 1))
    bit = F.expr(f"shiftleft(1L, cast(`{name}` & 63 as int))")
    found = df.groupBy(F.shiftright(last, 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(marks // 64, "<i8")
    words[found["at"].to_numpy()] = found["bits"].to_numpy()
    return df.sparkSession.sparkContext.broadcast(words.view(np.uint8))


def has(bits: Broadcast, hashes: np.ndarray) -> np.ndarray:
    at = hashes & (8 * len(bits.value) - 1)
    return (bits.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def only(rows: DataFrame, bits: Broadcast) -> DataFrame:
    """The rows (id, text) whose id may be among those marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (some := has(bits, batch["id"].to_numpy())).any():
                yield batch.filter(pa.array(some))

    return rows.select("id", "text").mapInArrow(run, "id long, text string")


def verified(pairs: DataFrame, pick: Pick, sets: Sets, similar: float, put: Put) -> DataFrame:
    """The distinct ``pairs`` (id, id2) whose texts have a Jaccard similarity of at least ``similar``.

    Each text goes to the text id2 that it is held against; a text with many partners goes to a group for each GROUP
    of them, so none is gathered in one task, and a group's first set is made once. ``pick`` may repeat an id.
    """
    pairs = put(pairs.distinct(), "pairs")
    wanted = put(pick(marked(pairs.select(F.explode(F.array("id", "id2")).alias("w")), "w")).dropDuplicates(["id"]), "wanted")
    sizes = pairs.groupBy(F.col("id2").alias("center")).agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    pairs = pairs.join(sizes, F.col("id2") == F.col("center")).withColumn("part", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int"))
    others = wanted.join(pairs, "id").select("center", "part", F.lit(1).alias("turn"), "id", "text")
    centers = wanted.join(sizes, F.col("id") == F.col("center")).select("center", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), F.lit(0).alias("turn"), "id", "text")
    grouped = centers.union(others).repartition("center", "part").sortWithinPartitions("center", "part", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, held = None, np.zeros(0, np.int64)
        for batch in slices(batches, most=AT_ONCE):
            out: tuple[list, list] = ([], [])
            for c, turn, i, own in zip(batch["center"].to_pylist(), batch["turn"].to_pylist(), batch["id"].to_pylist(), sets(texts(batch)), strict=True):
                if turn == 0:
                    center, held = c, own.copy()
                elif c == center and len(own):
                    both = np.concatenate([held, own])
                    both.sort()
                    shared = int(np.count_nonzero(both[1:] == both[:-1]))
                    if shared >= similar * (len(own) + len(held) - shared):
                        out[0].append(i)
                        out[1].append(c)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["id", "id2"])

    return put(grouped.mapInArrow(run, "id long, id2 long"), "verified")


def weights_of(rows: DataFrame, sets: Sets) -> Broadcast:
    """How many texts' shingles fall in each part of the hashes' range, where many do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PARTS, np.int64)
        for batch in slices(batches, most=AT_ONCE):
            total += np.bincount(np.concatenate([np.zeros(0, np.int64), *sets(texts(batch))]) & (PARTS - 1), minlength=PARTS)
        high = np.flatnonzero(total > 4 + 2 * total.mean())
        yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(total[high])], ["part", "n"])

    sums = rows.select("text").mapInArrow(run, "part long, n long").groupBy("part").agg(F.sum("n").alias("n")).toArrow()
    weights = np.zeros(PARTS, np.int64)
    weights[sums["part"].to_numpy()] = sums["n"].to_numpy()
    return rows.sparkSession.sparkContext.broadcast(weights)


def parities(found: np.ndarray, words: int = WORDS) -> np.ndarray:
    """64 ``words`` bits: whether an odd number of a set's hashes has each as its last bits. Two sets differ in at least as many hashes as bits."""
    odd = np.bincount(found & (64 * words - 1), minlength=64 * words).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


def with_parities(rows: DataFrame, sets: Sets, words: int = WORDS) -> DataFrame:
    """(id, size, parity) of each text: how many shingles it has, and their parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=AT_ONCE):
            found = sets(texts(batch))
            odd = np.concatenate([parities(x, words) for x in found])
            lists = pa.ListArray.from_arrays(np.arange(0, len(odd) + 1, words, dtype=np.int32), pa.array(odd))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array([len(x) for x in found], pa.int32()), lists], ["id", "size", "parity"])

    return rows.select("id", "text").mapInArrow(run, "id long, size int, parity array<long>")


def near(pairs: DataFrame, firsts: DataFrame, similar: float, words: int = WORDS) -> DataFrame:
    """The ``pairs`` (id, id2) whose sizes and parities in rows of prefixes(), one for each id, allow ``similar``: none that reaches it goes."""
    one, two = firsts.select("id", "size", "parity"), firsts.select(F.col("id").alias("id2"), F.col("size").alias("size2"), F.col("parity").alias("parity2"))
    apart = sum((F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("parity2")[i])) for i in range(words)), F.lit(0))
    both = F.col("size") + F.col("size2")
    return pairs.join(one, "id").join(two, "id2").where(both - apart >= 2 * similar / (1 + similar) * both - 1e-9).select("id", "id2")


def prefixes(rows: DataFrame, sets: Sets, similar: float, weights: Broadcast, bits: Broadcast | None = None, parity: bool = False) -> DataFrame:
    """(id, size, short, s, at): of each text the first shingles by rarity, of those that are marked, and their places; with ``parity``, all its parities too.

    With shingles in any one order, two texts x and y (x not the larger set) that reach t share one of x's first
    |x| - 2t/(1+t) |x| + 1 (``short``) and of y's first |y| - t |y| + 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=AT_ONCE):
            columns: list[list] = [[], [], [], [], [], []]
            for i, found in zip(batch["id"].to_pylist(), sets(texts(batch)), strict=True):
                n, odd = len(found), parities(found) if parity else None
                most, short = (n - int(np.ceil(share * n - 1e-9)) + 1 for share in (similar, 2 * similar / (1 + similar)))
                found = found[np.lexsort((found, weights.value[found & (PARTS - 1)]))][:most]
                at = np.flatnonzero(has(bits, found)) if bits else np.arange(len(found))
                if len(at):
                    for c, v in zip(columns, (i, n, short, found[at], at.astype(np.int32), odd), strict=True):
                        c.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[: 5 + parity], kinds, strict=False)], ["id", "size", "short", "s", "at", "parity"][: 5 + parity])

    return rows.select("id", "text").mapInArrow(run, FIRSTS + ", parity array<long>" * parity)


def repeated(firsts: DataFrame) -> DataFrame:
    """Rows of prefixes(), with parities, and with those of their shingles alone that stand in two rows or more; rows without any go.

    What is counted is a shingle's hash alone, and what is left goes through a filter of REPEATS bits, so that
    all that is shuffled by shingle after it is the part that can meet something.
    """
    twice = firsts.select(F.explode("s").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where("n > 1")
    bits = marked(twice, "s", REPEATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found, places = batch["s"].flatten(), batch["at"].flatten()
            stays = has(bits, found.to_numpy())
            before = np.concatenate([[0], np.cumsum(stays)])
            ends = before[np.concatenate([[0], np.cumsum(batch["s"].value_lengths().to_numpy())])].astype(np.int32)
            cut = [pa.ListArray.from_arrays(ends, c.filter(pa.array(stays))) for c in (found, places)]
            out = pa.RecordBatch.from_arrays([batch["id"], batch["size"], batch["short"], *cut, batch["parity"]], batch.schema.names)
            yield out.filter(pa.array(np.diff(ends) > 0))

    return firsts.select("id", "size", "short", "s", "at", "parity").mapInArrow(run, f"{FIRSTS}, parity array<long>")


def exploded(firsts: DataFrame, *more: str) -> DataFrame:
    """(s, id, size, left, short, ...): a row for each shingle of prefixes(); left: the shingles of its text from there on."""
    each = firsts.select("id", "size", F.col("short").alias("first"), *more, F.explode(F.arrays_zip("s", "at")).alias("m"))
    return each.select(F.col("m.s").alias("s"), "id", "size", (F.col("size") - F.col("m.at")).alias("left"), (F.col("m.at") < F.col("first")).alias("short"), *more)


def crossing(x: DataFrame, y: DataFrame, by: list[str]) -> DataFrame:
    """Pairs of rows of ``x`` (id, component, ...) and ``y`` (its columns end in 2) that agree on ``by`` and are of two components.

    The other components of a group come first, then their rows: a group that is mostly one component costs no row
    for each of its own pairs.
    """
    others = x.select(*by, F.col("component").alias("other")).distinct()
    left = y.join(others, by).where("component <> other").select(*by, *[F.col(c).alias(f"{c}2") for c in y.columns if c not in (*by, "component")], F.col("other").alias("component"))
    return left.join(x, [*by, "component"])


def reachable(size: Column, size2: Column, left: Column, left2: Column, similar: float) -> Column:
    """Whether two texts that share a shingle, with so many left from there, can reach ``similar``; the first isn't the larger."""
    can = F.least(left, left2) >= similar / (1 + similar) * (size + size2) - 1e-9
    return can & (size <= size2) & (size >= similar * size2 - 1e-9)


def shared_by_several(each: DataFrame, put: Put) -> DataFrame:
    """The rows (s, component, ...) whose shingle is in two components or more."""
    mixed = put(each.groupBy("s").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("s"), "mixed")
    return put(each.join(mixed, "s"), "met")


def partners(each: DataFrame, similar: float, turn: int) -> DataFrame:
    """(id, id2): of each text of exploded() rows with ``component``, at most PARTNERS of other components that share most of its prefix.

    A text is held against two of the texts of each shingle that are about as large, the first and the last by one of eight
    orders that ``turn`` changes: as many pairs as rows, however many share the shingle. A large component is
    met most often, and most of a group of near copies joins it, so that crossed() has no pairs for them.
    """
    # Sizes that can reach ``similar`` are mostly in one class of every other turn.
    sized = each.withColumn("class", F.floor(F.log("size") / F.log(F.lit(1 / similar**2)) + 0.5 * (turn % 2)))
    own = F.struct(F.xxhash64("id", F.col("s").bitwiseAND(F.lit(7)), F.lit(turn)).alias("turn"), "id", "component", "size", "left")
    ends = sized.groupBy("s", "class").agg(F.min(own).alias("lo"), F.max(own).alias("hi"), F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    met = sized.join(ends.drop("least", "most"), ["s", "class"]).select("id", "component", "size", "left", F.explode(F.array("lo", "hi")).alias("c")).where("component <> c.component")
    both = F.col("size") + F.col("c.size")
    can = (F.least("left", F.col("c.left")) >= similar / (1 + similar) * both - 1e-9) & (F.least("size", F.col("c.size")) >= similar / (1 + similar) * both - 1e-9)
    shares = met.where(can).groupBy("id", F.col("c.id").alias("id2")).agg(F.count("*").alias("n"))
    best = Window.partitionBy("id").orderBy(F.desc("n"), "id2")
    return shares.withColumn("at", F.row_number().over(best)).where(F.col("at") <= PARTNERS).select("id", "id2")


def crossed(each: DataFrame, similar: float, put: Put) -> DataFrame:
    """(id, id2) to verify of exploded() rows with ``component``: all pairs of two components that can reach ``similar``, each once."""
    met = shared_by_several(each, put)
    # The first shingle that a pair shares is met too, and no more than what is left from there can be shared.
    x, y = met.where("short").drop("short"), met.drop("short")
    # The other components of a shingle come first, with the most that a line of each could share with one of a size.
    others = x.groupBy("s", F.col("component").alias("other")).agg(F.max("left").alias("far"), F.min("size").alias("least"))
    need = similar / (1 + similar) * (F.col("size") + F.col("least")) - 1e-9
    some = y.join(others, "s").where((F.col("component") != F.col("other")) & (F.col("size") >= F.col("least")) & (F.least("left", "far") >= need))
    some = some.select("s", *[F.col(c).alias(f"{c}2") for c in ("id", "size", "left")], F.col("other").alias("component"))
    pairs = some.join(x, ["s", "component"]).where(reachable(F.col("size"), F.col("size2"), F.col("left"), F.col("left2"), similar))
    # Of equal sizes, either text is the one that isn't larger.
    pairs = pairs.where((F.col("size") < F.col("size2")) | (F.col("id") < F.col("id2")))
    return pairs.select("id", "id2")
