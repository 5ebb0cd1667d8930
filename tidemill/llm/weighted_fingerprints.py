"""Document fingerprints by consistent weighted sampling (Ioffe, 2010).

A text is a set of weighted terms: its words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, of
weight 1 + ln(times). For each of ``SAMPLES`` draws, a term of weight S has r and c from
Gamma(2, 1) and b from [0, 1), all from a hash of the term and the draw:
t = floor(ln S / r + b), ln y = r (t - b), ln a = ln c - ln y - r. The term of least a and its t
are the sample, and two texts share a sample with the probability of their generalised
Jaccard similarity, sum(min) / sum(max) of the weights. A fingerprint is a 16-bit digest of
each sample, as hex; a chance meeting of digests adds less than 2e-5 to a likeness.

Null is the empty text. A text without words has the fingerprint of the term "" alone, so
empty texts are alike (1.0) and unlike others. Repeated rows have equal fingerprints.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import append, slices, texts

SAMPLES = 64
#: Rows of a worker's table of drawn terms; beyond it the table starts anew.
TABLE_ROWS = 200_000
#: Terms that are looked up at once.
PART = 1024
LOW16 = np.uint64(0xFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(hashes: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """For each term and draw: ln a as an ordered 48-bit number, then the sample's digest of 16 bits."""

    def uniform(state: np.ndarray, shift: int) -> np.ndarray:
        return ((state >> np.uint64(shift) & np.uint64(0x1FFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-21)

    with np.errstate(over="ignore"):
        one = _mixed(hashes[:, None] + np.arange(1, samples + 1, dtype=np.uint64)[None] * np.uint64(0x9E3779B97F4A7C15))
        two = _mixed(one + np.uint64(0xD1B54A32D192ED03))
        r = -np.log(uniform(one, 0) * uniform(one, 21))
        ln_a = np.log(-np.log(uniform(two, 0) * uniform(two, 21)))
        b = uniform(two, 42)
        digest = one >> np.uint64(48)
        if (weights == 1).all():  # ln S is 0, and so is t
            ln_a += r * (b - np.float32(1))
        else:
            t = np.floor(np.log(weights)[:, None].astype(np.float32) / r + b)
            ln_a -= r * (t - b + np.float32(1))
            digest = np.where(t == 0, digest, _mixed(one ^ t.astype(np.int64).view(np.uint64)) >> np.uint64(48))
        bits = ln_a.view(np.uint32)
        ordered = bits ^ ((bits.view(np.int32) >> 31).view(np.uint32) | np.uint32(1 << 31))
    return (ordered.astype(np.uint64) << np.uint64(16)) | digest


class Fingerprinter:
    """Turns texts into fingerprints; keeps the draws of terms met before, in bounded space."""

    def __init__(self, samples: int = SAMPLES, table_rows: int = TABLE_ROWS) -> None:
        self.samples, self.most = samples, max(table_rows, PART)
        self.table = np.empty((0, samples), np.uint64)
        self.room = np.empty((PART, samples), np.uint64)
        self.rows: dict = {}  # by word, or by (word, times) where times > 1

    def __call__(self, found: list[bytes]) -> np.ndarray:
        """A row of 16-bit digests for each text."""
        out = np.empty((len(found), self.samples), np.uint16)
        group: list = []
        starts: list[int] = []
        first = 0
        for k, text in enumerate(found):
            terms = [x if n == 1 else (x, n) for x, n in Counter(text.lower().split()).items()] or [b""]
            if group and len(group) + len(terms) > PART:
                out[first:k] = self._least(group, starts)
                group, starts, first = [], [], k
            if len(terms) > PART:  # the least of the parts is the least of all
                parts = [self._packed(terms[i : i + PART], [0])[0] for i in range(0, len(terms), PART)]
                out[k], first = np.minimum.reduce(parts) & LOW16, k + 1
            else:
                starts.append(len(group))
                group += terms
        if starts:
            out[first:] = self._least(group, starts)
        return out

    def _least(self, terms: list, starts: list[int]) -> np.ndarray:
        return self._packed(terms, starts) & LOW16

    def _packed(self, terms: list, starts: list[int]) -> np.ndarray:
        while None in (rows := list(map(self.rows.get, terms))):
            self._draw([*{x for x, r in zip(terms, rows, strict=True) if r is None}])
        got = np.take(self.table, rows, axis=0, out=self.room[: len(rows)], mode="clip")
        return np.minimum.reduceat(got, starts, axis=0)

    def _draw(self, terms: list) -> None:
        if len(self.rows) + len(terms) > self.most:
            self.rows.clear()
        have = len(self.rows)
        if have + len(terms) > len(self.table):
            more = np.empty((min(self.most, 2 * (have + len(terms))), self.samples), np.uint64)
            more[:have] = self.table[:have]
            self.table = more
        terms.sort(key=lambda x: type(x) is bytes)  # those of weight 1 together
        for i in range(0, len(terms), 128):
            part = terms[i : i + 128]
            h = np.array([xxhash.xxh64_intdigest(x if type(x) is bytes else x[0]) for x in part], np.uint64)
            w = 1 + np.log(np.array([1 if type(x) is bytes else x[1] for x in part]))
            self.table[have + i : have + i + len(part)] = draws(h, w, self.samples)
        self.rows.update((x, have + i) for i, x in enumerate(terms))


@functools.cache
def kept(samples: int) -> Fingerprinter:
    """The worker's own, kept from task to task."""
    return Fingerprinter(samples)


def hexed(prints: np.ndarray) -> list[str]:
    """Fingerprints as lowercase hex, each digest little-endian."""
    return [x.tobytes().hex() for x in prints.astype("<u2")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of samples that two rows of fingerprints have in common."""
    return (a == b).mean(axis=-1)


def fingerprints(df: DataFrame, text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``df`` with a column ``fingerprint`` (any of that name is replaced); no shuffle."""
    df = df.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = kept(samples)
        for batch in slices(batches, text):
            yield append(batch, fingerprint=pa.array(hexed(made(texts(batch, text))), pa.string()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("fingerprint", T.StringType())]))


def in_order(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(part, extra, doc_id, text): rows dealt by ranges of doc_id and sorted in each.

    The range's successor, the first row of the next range (of the first range, for the
    last), stands behind it with extra = 1, so each row's successor is in its own partition.
    The order is by doc_id, then by the text's XXH64. Rows without a doc_id stand outside
    it, in extra = -1. The ranges' bounds are quantiles that are ids themselves, found in
    a scan of the ids alone; the driver holds one id for each range. The texts move once.
    """
    spark = docs.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    probs = F.array(*[F.lit(i / n) for i in range(1, n)] or [F.lit(0.5)])
    least, cuts = rows.agg(F.min("doc_id"), F.percentile_approx("doc_id", probs, max(10_000, 20 * n))).first()
    bounds = np.array(sorted({int(x) for x in cuts or [] if x > least}), np.int64)
    last = len(bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            known = np.asarray(ids.is_valid())
            values = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, values, side="right")
            # Rows without an id go anywhere.
            part[~known] = np.arange(len(part))[~known] % (last + 1)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.where(known, 0, -1), pa.int32()), ids, batch["text"]], names)
            ends = known & (np.isin(values, bounds) | (values == least))
            if ends.any():
                some = batch.filter(pa.array(ends))
                to = np.searchsorted(bounds, values[ends], side="right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(np.where(to < 0, last, to), pa.int32()), pa.array(np.ones(len(to)), pa.int32()), some["doc_id"], some["text"]], names)

    names = ["part", "extra", "doc_id", "text"]
    dealt = rows.mapInArrow(deal, "part int, extra int, doc_id long, text string").repartitionById(last + 1, F.col("part"))
    return dealt.sortWithinPartitions("extra", "doc_id", F.xxhash64("text"))


def edited(text: str, after: str) -> str:
    """The text with its last half (rounded down) replaced by as much of the start of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def against_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Each document's fingerprint, beside those of its edited text and of the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Of a row without a doc_id the next document is the empty text. A lone document is
    its own next one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = kept(samples)
        none = made([b""])
        held: tuple | None = None  # the last row, and its fingerprint, until the next one comes
        for batch in slices(batches):
            rows = list(zip(batch["extra"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True))
            prints = made([x[2].encode() for x in rows])
            pairs = []
            for (extra, doc_id, text), own in zip(rows, prints, strict=True):
                if extra < 0:
                    pairs.append((doc_id, text, own, "", none[0]))
                    continue
                if held is not None:
                    pairs.append((*held, text, own))
                held = None if extra else (doc_id, text, own)
            if pairs:
                yield out(made, pairs)

    def out(made: Fingerprinter, pairs: list[tuple]) -> pa.RecordBatch:
        changed = [edited(text, after).encode() for _, text, _, after, _ in pairs]
        new = np.concatenate([made(changed[i : i + 500]) for i in range(0, len(changed), 500)])
        own, nexts = np.stack([p[2] for p in pairs]), np.stack([p[4] for p in pairs])
        columns = {
            "doc_id": pa.array([p[0] for p in pairs], pa.int64()),
            "n_chars": pa.array([len(p[1]) for p in pairs], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in changed]),
            "fingerprint": pa.array(hexed(own)),
            "edited_fingerprint": pa.array(hexed(new)),
            "near_edited": pa.array(likeness(own, new)),
            "near_next": pa.array(likeness(own, nexts)),
        }
        return pa.RecordBatch.from_pydict(columns)

    return in_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op2_weighted_fingerprints(spark, sf_dir: str) -> DataFrame:
    return against_edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
