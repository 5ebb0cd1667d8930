"""Collocations by position bitmaps (SPAM: Ayres et al., 2002): shift, AND, popcount.

A shard is some texts of one language, about ``SHARD`` words one after another, a gap between pieces. Each of its words has a bitmap of the places it
stands at, of which only the 16-bit blocks that aren't zero are kept. A phrase's bitmap marks its last words; shifted by one place and ANDed
with a word's it is that of the phrase with this word after it, and gaps, which no word has, keep phrases within pieces. All words that
stand in a block are ANDed with it at once. Phrases are extended depth-first from some first words at a time (``BATCH`` blocks), so a task holds
a shard and one such branch.

Shards are written once. Three passes over them, each adding popcounts over all shards: words; pairs of words that are frequent; triples
and quadruples that go through frequent pairs alone. What is frequent reaches the workers as a filter of ``FILTER_BITS`` bits, of one size
however large the corpus is: it lets all frequent ones through and some others, which the exact sums after drop. So pairs are first
counted by ``HASH_BITS`` bits of their hash, which can only add up to more, and by their words with the longer ones. Counts are of all places;
a piece longer than a shard goes on in the next one, and the three words that both have count as first words in one.

Null texts are empty; a null lang is ``und``; blank texts, empty pieces and empty tables give nothing. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import slices, table, texts

LONGEST, LEAST, MOST_PCT, FIRST = 4, 30, 80, 2000
#: Words of a shard, and bytes of its distinct words, after which another begins.
SHARD, SHARD_BYTES = 1 << 19, 16 << 20
#: Words that all languages' open shards of a task hold together.
OPEN = 1 << 20
BATCH = 1 << 14
#: Shards of a row group: a shard is some MB, and a task holds a row group.
GROUP = 2
FILTER_BITS, HASH_BITS = 1 << 26, 40
SLAB = 1 << 20
UNKNOWN = "und"

_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes(0x0A if c in _ENDS else 0x20 if c == 9 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_EMPTY, _GAP = 0, 1


class _Words(dict):
    """A shard's words by number; 0 is nothing, 1 the gap."""

    def __init__(self) -> None:
        super().__init__({b"": _EMPTY, b"\n": _GAP})
        self.bytes = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.bytes += len(word)
        return n


def _slabs(text: bytes) -> Iterator[bytes]:
    """A text in parts that end where words do."""
    at = 0
    while at < len(text):
        end = at + SLAB
        if end < len(text):
            found = [x for x in (text.find(b" ", end), text.find(b"\n", end)) if x >= 0]
            end = min(found) if found else len(text)
        yield text[at:end]
        at = end


class _Open:
    """A shard that is being filled; ``ends`` are the words after it that only close its phrases."""

    def __init__(self, lang: str) -> None:
        self.lang, self.words, self.parts, self.n, self.ends = lang, _Words(), [np.array([_GAP], np.int32)], 1, []

    def add(self, words: list[bytes]) -> None:
        ids = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        ids = ids[ids != _EMPTY]
        self.parts.append(ids)
        self.n += len(ids)

    def closed(self, words: list[bytes]) -> bool:
        """Take the next words as ends, up to the piece's end; whether no more are needed."""
        for w in words:
            if w == b"\n" or len(self.ends) == LONGEST - 1:
                return True
            if w:
                self.ends.append(w)
        return len(self.ends) == LONGEST - 1


def bitmaps(places: np.ndarray, tail: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of words at places: each block's first entry, and entries (word, bits) by block; and the bits of first words by block."""
    at = np.flatnonzero(places > _GAP)
    keys = (at >> 4) << 32 | places[at]
    order = np.argsort(keys, kind="stable")
    keys, bits = keys[order], (1 << (at[order] & 15)).astype(np.uint16)
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    blocks = (keys[starts] >> 32).astype(np.int64)
    count = (len(places) >> 4) + 2
    offsets = np.searchsorted(blocks, np.arange(count + 1)).astype(np.int32)
    heads = np.full(count, 0xFFFF, np.uint16)
    if tail:
        first = len(places) - tail
        heads[(first >> 4) + 1 :] = 0
        heads[first >> 4] = (1 << (first & 15)) - 1
    return offsets, (keys[starts] & 0xFFFFFFFF).astype(np.int32), np.bitwise_or.reduceat(bits, starts) if len(starts) else bits, heads


SHARDS = "lang string, words array<string>, counts array<long>, offsets binary, entries binary, bits binary, heads binary"
_SHARDS = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())), *((x, pa.binary()) for x in ("offsets", "entries", "bits", "heads"))])


def _row(shard: _Open) -> pa.RecordBatch:
    shard.add(shard.ends)
    offsets, entries, bits, heads = bitmaps(np.concatenate(shard.parts), len(shard.ends))
    blocks = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    counts = np.bincount(entries, np.bitwise_count(bits & heads[blocks]), len(shard.words)).astype(np.int64)
    columns = [[shard.lang], [list(shard.words)[2:]], [counts[2:]], *([x.tobytes()] for x in (offsets, entries - 2, bits, heads))]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _SHARDS.types, strict=True)], schema=_SHARDS)


def shards(docs: DataFrame, text: str = "text", lang: str = "lang", words: int = SHARD) -> DataFrame:
    """The shards of the texts by language, of so many words each."""
    rows = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filling: dict[str, _Open] = {}
        for batch in slices(batches):
            for key, x in zip(batch["lang"].to_pylist(), texts(batch), strict=True):
                cut: _Open | None = None  # a full shard whose last piece goes on
                for slab in _slabs(x.translate(_PLAIN)):
                    waiting = slab.replace(b"\n", b" \n ").split(b" ")
                    while waiting:
                        if cut and cut.closed(waiting):
                            yield _row(cut)
                            cut = None
                        shard = filling.get(key) or filling.setdefault(key, _Open(key))
                        room = max(LONGEST, words - shard.n)
                        shard.add(waiting[:room])
                        waiting = waiting[room:]
                        if shard.n >= words or shard.words.bytes >= SHARD_BYTES:
                            if cut:  # nothing but blanks came since
                                yield _row(cut)
                            cut = filling.pop(key)
                if cut:
                    yield _row(cut)
                if key in filling:
                    filling[key].add([b"\n"])
                while sum(s.n for s in filling.values()) > OPEN:
                    yield _row(filling.pop(max(filling, key=lambda k: filling[k].n)))
        yield from map(_row, filling.values())

    return rows.mapInArrow(run, SHARDS)


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """As Spark's xxhash64(lang, word)."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


_LOW, _HASH, _UP = np.uint64(FILTER_BITS - 1), np.uint64((1 << HASH_BITS) - 1), np.uint64(HASH_BITS - FILTER_BITS.bit_length() + 1)


class Filter:
    """Which hashes may be known: two bits of each are set, of its lower and its upper part."""

    def __init__(self, hashes: DataFrame, h: str) -> None:
        two = F.array(*[F.expr(f"shiftrightunsigned({h}, {n}) & {FILTER_BITS - 1}") for n in (0, int(_UP))])
        bits = hashes.select(F.explode(two).alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("word")).toArrow()
        self.words = np.zeros(FILTER_BITS >> 6, np.uint64)
        self.words[bits["at"].to_numpy()] = bits["word"].to_numpy().view(np.uint64)

    def holds(self, h: np.ndarray) -> np.ndarray:
        get = lambda p: self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)
        return (get(h & _LOW) & get(h >> _UP & _LOW)).astype(bool)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of HASH_BITS bits for two words in a row."""
    return (a ^ (b >> np.uint64(7)) ^ (b << np.uint64(29))) & _HASH


class Shard:
    """A shard's bitmaps, of the words that pass a filter."""

    def __init__(self, row: dict, words: Filter) -> None:
        self.lang, self.words = row["lang"], row["words"]
        get = lambda x, kind: np.frombuffer(row[x], kind)
        offsets, entries, bits, heads = get("offsets", np.int32), get("entries", np.int32), get("bits", np.uint16), get("heads", np.uint16)
        self.hashes = _hashes(self.lang, self.words)
        keep = words.holds(self.hashes)[entries] if len(entries) else np.zeros(0, bool)
        blocks = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[keep]
        self.entries, self.bits = entries[keep].astype(np.int64), bits[keep].astype(np.uint32)
        self.offsets = np.searchsorted(blocks, np.arange(len(offsets) + 1))
        first = self.bits & heads[blocks]
        order = np.argsort(self.entries, kind="stable")
        order = order[first[order] > 0]
        self.firsts = self.entries[order], blocks[order], first[order]

    def branches(self, most: int = BATCH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Bitmaps (word, block, bits) of some first words at a time, of about so many blocks."""
        word, block, bits = self.firsts
        edges = np.r_[np.flatnonzero(np.diff(word, prepend=-1)), len(word)]
        at = 0
        while at < len(edges) - 1:
            end = max(at + 1, int(np.searchsorted(edges, edges[at] + most, side="right")) - 1)
            cut = slice(edges[at], edges[end])
            yield word[cut], block[cut], bits[cut]
            at = end

    def extended(self, phrase: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each phrase's bitmap shifted by a place and ANDed with those of all words there: (phrase, word, block, bits) that aren't zero."""
        moved = bits << 1
        low, high = moved & 0xFFFF, moved >> 16
        a, b = np.flatnonzero(low), np.flatnonzero(high)
        phrase, block, bits = np.r_[phrase[a], phrase[b]], np.r_[block[a], block[b] + 1], np.r_[low[a], high[b]]
        start, n = self.offsets[block], self.offsets[block + 1] - self.offsets[block]
        of = np.repeat(np.arange(len(block)), n)
        at = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
        both = bits[of] & self.bits[at]
        some = np.flatnonzero(both)
        of, at = of[some], at[some]
        return phrase[of], self.entries[at], block[of], both[some]

    def counted(self, phrase: np.ndarray, word: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Phrases with a word more: their numbers among themselves, and each one's first part, word and popcount."""
        keys, own = np.unique(phrase * len(self.words) + word, return_inverse=True)
        return own, keys // len(self.words), keys % len(self.words), np.bincount(own, np.bitwise_count(bits), len(keys)).astype(np.int64)


def _told(lang: str, parts: list[pa.Array], counts: np.ndarray) -> pa.RecordBatch:
    phrases = pc.binary_join_element_wise(*parts, " ")
    return pa.RecordBatch.from_arrays([pa.array([lang]).take(pa.array(np.zeros(len(counts), np.int32))), phrases, pa.array(counts)], ["lang", "phrase", "n"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch[c][i] for c in ("lang", "words", "offsets", "entries", "bits", "heads")}
            yield {c: v.values.cast(pa.binary()).to_pylist() if c == "words" else v.as_py() if c == "lang" else v.as_buffer() for c, v in row.items()}


def _pairs(held: DataFrame, words: Filter) -> DataFrame:
    """(h, n): how often pairs of each hash occur in a shard."""
    sent = held.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = Shard(row, sent.value)
            for word, block, bits in shard.branches():
                first, second, _, both = shard.extended(word, block, bits)
                _, a, b, n = shard.counted(first, second, both)
                yield pa.RecordBatch.from_arrays([pa.array(_pair(shard.hashes[a], shard.hashes[b]).view(np.int64)), pa.array(n)], ["h", "n"])

    return held.mapInArrow(run, "h long, n long")


def _longer(held: DataFrame, words: Filter, pairs: Filter) -> DataFrame:
    """(lang, phrase, n): how often phrases of two to LONGEST words, all of whose pairs pass the filter, occur in a shard."""
    sent = held.sparkSession.sparkContext.broadcast((words, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            shard = Shard(row, sent.value[0])
            names = pa.array(shard.words, pa.string())
            known = sent.value[1]
            for word, block, bits in shard.branches():
                # Each phrase of the branch as the columns of its words.
                line = [word]
                own = np.arange(len(word))
                for size in range(2, LONGEST + 1):
                    of, second, block, bits = shard.extended(own, block, bits)
                    go = np.flatnonzero(known.holds(_pair(shard.hashes[line[-1][of]], shard.hashes[second])))
                    # Equal phrases of many blocks are one phrase: by their first part, which is one already from the second word on.
                    before = line[0][of[go]] if size == 2 else of[go]
                    block, bits = block[go], bits[go]
                    own, first, last, n = shard.counted(before, second[go], bits)
                    line = [first, last] if size == 2 else [*[x[first] for x in line], last]
                    if not len(n):
                        break
                    yield _told(shard.lang, [names.take(pa.array(x)) for x in line], n)

    return held.mapInArrow(run, "lang string, phrase string, n long")


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", words: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all words and phrases that occur at least LEAST times, and (lang, n) of all words."""
    held = table(shards(docs, text, lang, words), "shards", batch=100, codec="zstd", group=GROUP)
    every = held.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("lang", F.col("x.words").alias("phrase"), F.col("x.counts").alias("n"))
    summed = table(every.groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    totals = summed.groupBy("lang").agg(F.sum("n").alias("n"))
    one = summed.where(F.col("n") >= LEAST)
    known = Filter(one.select(F.xxhash64("lang", "phrase").alias("h")), "h")
    often = table(_pairs(held, known).groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST).select("h"), "pairs", batch=1)
    more = table(_longer(held, known, Filter(often, "h")).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST), "longer", batch=1)
    sized = lambda df: df.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), F.col("n").alias("f"))
    return sized(one.unionByName(more)), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", shard: int = SHARD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases by their weakest cut."""
    found, totals = phrases(docs, text, lang, shard)
    longer = found.where("size >= 2")
    words = F.split("phrase", " ")
    piece = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    cuts = longer.select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    sides = F.array(F.struct(F.lit(0).alias("side"), piece(F.lit(1), F.col("k")).alias("part")), F.struct(F.lit(1).alias("side"), piece(F.col("k") + 1, F.col("size") - F.col("k")).alias("part")))
    parts = cuts.select("lang", "phrase", "a", "k", F.inline(sides))
    met = parts.join(found.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("f")))
    exact = "CAST((CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)"
    by_cut = met.groupBy("lang", "phrase", "a", "k").agg(of(0).alias("l"), of(1).alias("r")).withColumn("score", F.expr(exact))
    weakest = by_cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    # Phrases within longer ones that occur nearly as often.
    inner = F.expr("flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), i -> array_join(slice(split(phrase, ' '), i, w), ' '))))")
    within = longer.where("size >= 3").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    stays = weakest.join(within, ["lang", "phrase"], "left").where(f"most IS NULL OR CAST(most AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * {MOST_PCT}")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = stays.withColumn("rank", F.row_number().over(first).cast("long")).where(F.col("rank") <= FIRST)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_position_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT d, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
lists AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
tokens AS (SELECT p, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM lists),
grams AS (SELECT lang, w AS w1, lead(w, 1) OVER q AS w2, lead(w, 2) OVER q AS w3, lead(w, 3) OVER q AS w4 FROM tokens WINDOW q AS (PARTITION BY p ORDER BY i)),
f AS (
  SELECT lang, phrase, size, count(*) AS f FROM (
    SELECT lang, w1 AS phrase, 1 AS size FROM grams
    UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM grams WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM grams WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM grams WHERE w4 IS NOT NULL) GROUP BY lang, phrase, size HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM tokens GROUP BY lang),
long_ AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size >= 2),
cuts AS (SELECT lang, phrase, a, ws, size, unnest(range(1, size)) AS k FROM long_),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:c.size], ' ')),
weakest AS (SELECT lang, phrase, a, l, r, score FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
widths AS (SELECT lang, ws, size, a, unnest(range(2, size)) AS w FROM long_ WHERE size >= 3),
subs AS (SELECT lang, ws, w, a, unnest(range(1, size - w + 2)) AS i FROM widths),
within AS (SELECT lang, array_to_string(ws[i:i + w - 1], ' ') AS phrase, max(a) AS most FROM subs GROUP BY ALL)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM (
  SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank, s.phrase, s.a, s.l, s.r, n.n, s.score
  FROM weakest s JOIN n ON n.lang = s.lang LEFT JOIN within i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.most IS NULL OR 100 * i.most::HUGEINT < 80 * s.a::HUGEINT) WHERE rank <= 2000
"""
