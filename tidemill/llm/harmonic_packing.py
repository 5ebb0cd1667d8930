"""Harmonic packing of token sequences.

A document's ids are closed by ``END``. Of one longer than ``CAPACITY`` whole sequences are cut off first. What is
left, mostly a whole document, is of class j if its length is in (CAPACITY / (j + 1), CAPACITY / j]; j of them fill a
bin of that class, whichever they are, so each worker fills its own bins as documents come: there is no shuffle and
nothing is agreed between workers. What j documents leave free in their bin is less than a CAPACITY / (j + 1), and is
filled with a piece cut off one more document, the filler; when a filler is used up, the next document that comes is the
next one. So only fillers, and documents of more than CAPACITY, are cut, and no sequence is padded. When a worker's rows
end, what is left in its open bins is put one after the other in sequences of CAPACITY, and the last of
it in sequences of powers of two, which are not padded either.

What a worker holds is bounded: at most j documents' places for each of some 90 classes. Null texts are empty: one piece
with END alone. Sequence ids are those of the worker's partition and a running number, the same again if the task is
run again.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.chunk_bpe import default_vocabulary, words_of
from tidemill.llm.common import holds, slices, texts

CAPACITY = 2048
END = 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Piece(NamedTuple):
    doc_id: int | None
    ids: bytes  # of this piece, four bytes each
    start: int
    tokens: int  # of the whole document

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: 4 * length]), self._replace(ids=self.ids[4 * length :], start=self.start + length)


class Bins:
    """One worker's open bins; put() and close() give rows of SCHEMA for each sequence that is full."""

    def __init__(self, first: int, capacity: int = CAPACITY) -> None:
        self.next, self.capacity = first, capacity
        self.open: dict[int, list[Piece]] = {}
        self.filler: Piece | None = None
        self.waiting: list[list[Piece]] = []  # full bins with space that no filler was there for

    def _sequence(self, pieces: list[Piece]) -> Iterator[tuple]:
        at = 0
        for p in pieces:
            yield p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.tokens, self.next, at
            at += p.length
        self.next += 1

    def put(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        rest = Piece(doc_id, ids, 0, len(ids) // 4)
        while rest.length >= self.capacity:
            whole, rest = rest.cut(self.capacity)
            yield from self._sequence([whole])
        if not rest.length:
            return
        if self.filler is None:
            self.filler = rest
            waiting, self.waiting = self.waiting, []
            for held in waiting:
                yield from self._fill(held)
            return
        kind = self.capacity // rest.length
        held = self.open.setdefault(kind, [])
        held.append(rest)
        if len(held) == kind:
            yield from self._fill(self.open.pop(kind))

    def _fill(self, held: list[Piece]) -> Iterator[tuple]:
        """Close a bin with what the filler has; if that is not enough, it waits for the next one."""
        free = self.capacity - sum(p.length for p in held)
        if free and self.filler is not None:
            some, left = self.filler.cut(min(free, self.filler.length))
            self.filler = left if left.length else None
            held = [*held, some]
            free -= some.length
        if free:
            self.waiting.append(held)
        else:
            yield from self._sequence(held)

    def close(self) -> Iterator[tuple]:
        """What is left: one piece after the other in whole sequences, then in sequences of powers of two."""
        left = [p for held in (*self.waiting, *self.open.values()) for p in held] + ([self.filler] if self.filler else [])
        self.open, self.waiting, self.filler = {}, [], None
        todo, at = sum(p.length for p in left), 0
        while todo:
            free = size = min(self.capacity, 1 << todo.bit_length() - 1)
            held = []
            while free:
                some, rest = left[at].cut(min(free, left[at].length))
                held.append(some)
                left[at] = rest
                at += not rest.length
                free -= some.length
            todo -= size
            yield from self._sequence(held)


def packed(docs: DataFrame, encoder: Callable[[], Callable[[list[bytes]], list[bytes]]], capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece: SCHEMA. ``encoder()`` gives, on a worker, the function from texts to their ids' bytes."""
    if capacity & capacity - 1:
        raise ValueError("the capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        bins = Bins(TaskContext.get().partitionId() << 36, capacity)
        end = END.to_bytes(4, "little")
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode(texts(batch)), strict=True):
                rows += bins.put(doc_id, ids + end)
            if rows:
                yield batched(rows)
        if rows := list(bins.close()):
            yield batched(rows)

    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def batched(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)


def packed_words(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """packed() with the ids of the vocabulary at ``path``."""
    path = path or default_vocabulary()

    def encoder() -> Callable[[list[bytes]], list[bytes]]:
        holds("packing", words_of.cache_clear)
        return words_of(path, False).ids_of

    return packed(docs, encoder, capacity)


def op5_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
