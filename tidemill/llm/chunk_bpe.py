"""BPE encoding and decoding with reuse of content-defined chunks.

A text's bytes are cut where a rolling hash of the last ``WINDOW`` bytes has its lowest
``CHUNK_BITS`` bits zero, so documents that share a passage share its chunks wherever they
stand. A worker encodes a chunk once and keeps the result of chunks met twice, in bounded
space. A cut may fall inside a word, so a chunk is kept as a head (up to its first white
space), a middle that doesn't depend on what stands around it, and a tail; the join of two
chunks is repaired by encoding the tail and the head together, through whole chunks without
white space where there are any, until both sides agree on where a word ends. As the
vocabulary's pre-tokenizer never crosses ASCII white space, and neither lower-casing, NFC nor
the special tokens do, the repaired ids are exactly those of the whole text.

Reuse is within each worker: to encode a chunk once in a whole cluster, each chunk's text would
have to be shuffled, which costs more than encoding it.

Null is the empty text: no ids, and "" decoded. Repeated rows give equal results.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemill.llm.common import append, slices, texts

WINDOW = 32
CHUNK_BITS = 10
#: What a worker keeps: words, and bytes of chunks with their ids and tokens.
MOST_WORDS, MOST_CHUNK_BYTES, MOST_SEEN = 500_000, 64 << 20, 1_000_000

_GEAR = np.array([xxhash.xxh32_intdigest(bytes([i])) for i in range(256)], np.uint32)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cuts(text: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Places of ``text`` where a chunk ends."""
    h = _GEAR[np.frombuffer(text, np.uint8)]
    step = 1
    while step < WINDOW:  # doubles the hashed window: h[i] covers the 2 * step bytes up to i
        h[step:] += h[:-step] << np.uint32(step) if step < 32 else 0
        step *= 2
    mask = np.uint32((1 << bits) - 1) << np.uint32(32 - bits)
    return [*(np.flatnonzero((h & mask) == 0) + 1).tolist()]


#: The vocabulary's pre-tokens, as its file states them, for words of ASCII and Latin-1 letters; and
#: the space that stands here between words.
_PRETOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^ a-z0-9\u00df-\u00f6\u00f8-\u00ff]+| ").findall
#: Between the ids of words, and between their tokens, that are made at once: no four bytes of ids, and no byte of a token.
IDS_END, NAME_END = b"\xff" * 4, b"\xff"
#: Bytes of no plain word: white space and control bytes, and the first byte of a letter that isn't Latin-1's.
_ODD = np.array([b < 0x21 or b == 0x7F or (b >= 0xC0 and b != 0xC3) for b in range(256)])


def _plain_ones(words: list[bytes]) -> list[bytes]:
    """Those that are of printable ASCII and Latin-1 letters, without what may begin a special token."""
    codes = np.frombuffer(b"".join(words), np.uint8)
    odd = _ODD[codes]
    odd[1:] |= (codes[:-1] == 0xC3) & ((codes[1:] == 0x97) | (codes[1:] == 0xB7))  # the signs among Latin-1's letters
    odd[:-1] |= (codes[:-1] == ord("<")) & (codes[1:] == ord("|"))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    before = np.concatenate([[0], np.cumsum(odd)])[np.concatenate([[0], ends])]
    return [*itertools.compress(words, (np.diff(before) == 0).tolist())]


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write the bytes that aren't printable Latin-1 letters."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in printable) if b != 0x20}


class Words:
    """The ids of words without ASCII white space, as the tokenizers library gives them.

    Words of printable ASCII and Latin-1 letters, for which NFC does nothing, are cut into
    pre-tokens here, and each distinct pre-token goes once through the vocabulary's model.
    Other words go through the whole tokenizer, with a mark between them.
    """

    def __init__(self, path: str, most: int = MOST_WORDS) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        with open(path) as f:
            about = json.load(f)
        suffix = about["model"]["end_of_word_suffix"]
        if about["decoder"] is not None or not suffix or _PRETOKENS.__self__.pattern.split("|[a-z")[0] not in str(about["pre_tokenizer"]):
            raise ValueError(f"{path}: not a vocabulary of words with ends")
        self.encode_all = lambda x: tokenizer.encode_batch_fast([x], add_special_tokens=False)[0].ids
        bare = Tokenizer(tokenizer.model)
        bare.pre_tokenizer = WhitespaceSplit()
        self.encode_bare = lambda x: bare.encode_batch_fast([x], add_special_tokens=False)[0].ids
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        names = [tokenizer.id_to_token(i) or "" for i in range(size)]
        self.tokens = [x.encode() + b" " for x in names]
        self.ends = np.array([x.endswith(suffix) for x in names])
        self.closed = [x + NAME_END * end for x, end in zip(self.tokens, self.ends.tolist(), strict=True)]
        self.letters = _byte_letters()
        [self.mark] = self.encode_all("\x01")
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, bytes] = {}
        self.named: dict[bytes, bytes] = {}  # each token followed by a space
        self.pre: dict[str, bytes] = {" ": IDS_END}
        self.pre_named: dict[str, bytes] = {" ": NAME_END}

    def know(self, words: Iterable[bytes], tokens: bool) -> None:
        """See that all of ``words`` are in the tables."""
        words = {*words}
        missing = [*words.difference(self.named if tokens else self.ids)]
        if not missing:
            return
        if len(self.ids) + len(missing) > self.most:
            self.clear()
            missing = [*words]
        plain = _plain_ones(missing)
        if plain:
            self._plain(plain, tokens)
        if len(plain) < len(missing):
            rest = {*missing} - {*plain}
            self._other([w for w in rest if b"\x01" not in w], [w for w in rest if b"\x01" in w])

    def _plain(self, words: list[bytes], tokens: bool) -> None:
        """Pre-tokens of all words go through the model, and are put together again, in a few calls for all of them."""
        found = _PRETOKENS(b" ".join(words).decode().lower())
        new = [*{*found}.difference(self.pre_named if tokens else self.pre)]
        if new:
            ascii_ = [x for x in new if x.isascii()]
            rest = [x for x in new if not x.isascii()]
            new = [*ascii_, *rest]
            ids = np.array(self.encode_bare(" ".join([*ascii_, " ".join(rest).encode().decode("latin-1").translate(self.letters)])), "<u4")
            ends = self.ends[ids]
            whole = np.full(len(ids) + len(new), 0xFFFFFFFF, "<u4")
            whole[np.arange(len(ids)) + np.cumsum(ends) - ends] = ids
            self.pre.update(zip(new, whole.tobytes().split(IDS_END)[:-1], strict=True))
            if tokens:
                self.pre_named.update(zip(new, b"".join(map(self.closed.__getitem__, ids.tolist())).split(NAME_END)[:-1], strict=True))
        self.ids.update(zip(words, b"".join(map(self.pre.__getitem__, found)).split(IDS_END), strict=True))
        if tokens:
            self.named.update(zip(words, b"".join(map(self.pre_named.__getitem__, found)).split(NAME_END), strict=True))

    def _other(self, words: list[bytes], marked: list[bytes]) -> None:
        out = [(w, self.encode_all(w.decode())) for w in marked]
        for i in range(0, len(words), 1000):
            part = words[i : i + 1000]
            ids = [*self.encode_all(b" \x01 ".join(part).decode()), self.mark]
            start = 0
            for w in part:
                end = ids.index(self.mark, start)
                out.append((w, ids[start:end]))
                start = end + 1
        for w, ids in out:
            self.ids[w] = np.array(ids, "<u4").tobytes()
            self.named[w] = b"".join([self.tokens[i] for i in ids])

    def encode(self, text: bytes, tokens: bool) -> tuple[bytes, bytes]:
        words = text.split()
        try:
            return self._looked_up(words, tokens)
        except KeyError:
            self.know(words, tokens)
            return self._looked_up(words, tokens)

    def _looked_up(self, words: list[bytes], tokens: bool) -> tuple[bytes, bytes]:
        return b"".join(map(self.ids.__getitem__, words)), b"".join(map(self.named.__getitem__, words)) if tokens else b""

    def know_all(self, found: list[bytes], tokens: bool) -> None:
        """Take the words of all these texts to the model at once: a call of its own for each text or chunk costs more than its words."""
        self.know(itertools.chain.from_iterable(map(bytes.split, found)), tokens)

    def ids_of(self, found: list[bytes]) -> list[bytes]:
        """The ids of each of these texts; they are cut into words once."""
        cut = [x.split() for x in found]
        self.know(itertools.chain.from_iterable(cut), False)
        return [b"".join(map(self.ids.__getitem__, x)) for x in cut]


@functools.cache
def words_of(path: str, tokens: bool = True) -> Words:
    """The worker's own tables, kept from task to task; one for each use."""
    return Words(path)


_FIRST = re.compile(rb"[\t-\r ]").search


class Chunks:
    """Encodes whole texts by chunks."""

    def __init__(self, path: str, tokens: bool = True, most: int = MOST_CHUNK_BYTES) -> None:
        self.words, self.tokens, self.most = words_of(path, tokens), tokens, most
        self.seen: set[int] = set()
        self.kept: dict[bytes, tuple] = {}
        self.bytes = self.reused = self.encoded = 0

    def _chunk(self, chunk: bytes) -> tuple | None:
        """(head, middle's ids, middle's tokens, tail), or None of a chunk without white space."""
        if (found := self.kept.get(chunk)) is not None:
            self.reused += 1
            return found
        first = _FIRST(chunk)
        if not first:
            return None
        tail = len(chunk) if chunk[-1:].isspace() else len(chunk) - len(chunk.rsplit(None, 1)[-1])
        made = (chunk[: first.start()], *self.words.encode(chunk[first.start() : tail], self.tokens), chunk[tail:])
        self.encoded += 1
        mark = xxhash.xxh3_64_intdigest(chunk)
        if mark in self.seen:
            if self.bytes > self.most:
                self.kept.clear()
                self.bytes = 0
            self.kept[chunk] = made
            self.bytes += 2 * len(chunk) + sum(map(len, made)) + 300
        else:
            if len(self.seen) >= MOST_SEEN:
                self.seen.clear()
            self.seen.add(mark)
        return made

    def encode_each(self, found: list[bytes]) -> list[tuple[bytes, bytes]]:
        self.words.know_all(found, self.tokens)
        return [self.encode(x) for x in found]

    def encode(self, text: bytes) -> tuple[bytes, bytes]:
        """The ids as little-endian unsigned 32-bit numbers, and the decoded text."""
        ids, named = [], []
        start, open_ = 0, []
        for end in [*cuts(text), len(text)]:
            chunk, start = text[start:end], end
            parts = self._chunk(chunk)
            if parts is None:
                open_.append(chunk)  # no agreement yet: the join reaches through this chunk
                continue
            a, b = self.words.encode(b"".join([*open_, parts[0]]), self.tokens)
            ids += (a, parts[1])
            named += (b, parts[2])
            open_ = [parts[3]]
        a, b = self.words.encode(b"".join(open_), self.tokens)
        return b"".join([*ids, a]), b"".join([*named, b])[:-1]


@functools.cache
def chunks_of(path: str, tokens: bool) -> Chunks:
    return Chunks(path, tokens)


def encoded(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of int) and ``decoded``; no shuffle."""
    df = df.drop("ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = chunks_of(path, True)
        for batch in slices(batches, text):
            got = made.encode_each(texts(batch, text))
            ids = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x, _ in got], pa.list_(pa.int32()))
            yield append(batch, ids=ids, decoded=pa.array([x.decode() for _, x in got], pa.string()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]))


def digests(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what encoded() gives, as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = chunks_of(path, True)
        for batch in slices(batches):
            got = made.encode_each(texts(batch))
            columns = [
                batch["doc_id"],
                pa.array([len(x) // 4 for x, _ in got], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x, _ in got]),
                pa.array([hashlib.sha256(x).hexdigest() for _, x in got]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(df["doc_id"].cast("long").alias("doc_id"), df["text"].cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
