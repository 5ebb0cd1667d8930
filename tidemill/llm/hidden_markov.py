"""Language-model scores by a hidden Markov model over words.

Tokens: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end for each text. Counts of all
training tokens are taken over the whole corpus, by the words' XXH64 (with 64 bits, a
chance meeting of two words among 10**9 has odds of 3 %, and shifts one count).

The model has ``STATES`` latent states. A state emits one of the ``CORE`` most frequent words, or one of ``CLASSES``
classes of the other words (by their last three bytes), and another word w then has the probability (c+1) / (sum of c+1
over its class + 1), an unknown one 1 / (the same): each state's probabilities add up to 1 over all known words and one
unknown of each class. So every word of the corpus has a share in the states' emissions, its own count, and no sample is taken.

Training is Baum-Welch. The first guess comes from how often each class of words follows each other one (``GUESS``
classes) in the whole corpus, to which a small model is fitted on the driver. Then in each round expected counts of the
starts, the transitions and the emissions are taken in every partition over all training texts and summed by word; only
sums, whose size is set by CORE, CLASSES and STATES, reach the driver. A text is worked on in parts of ``SEGMENT`` tokens
with ``CONTEXT`` more on either side: each token and each transition counts once, in the part that it is inside of. A
text's score is the scaled forward recursion over the whole of it, uncut, in doubles.

Texts are cut into words twice, to count them and to number them; the rounds and the scores work on numbers. At most
``KNOWN`` words' counts are sent to the workers; the counts of rarer words are joined to the texts' rare words by hash.

Null is the empty text: one token, the end. A missing doc_id counts as the text "" where rows
are held out. If nothing is left to train on, the score is that of unknown tokens.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import slices, table, texts

STATES, CORE, KNOWN = 16, 32_768, 600_000
CLASSES, GUESS = 1024, 256
ROUNDS, GUESS_ROUNDS, SEGMENT, CONTEXT = 2, 200, 256, 16
#: Weight of the corpus's own word probabilities in a state's.
PRIOR = 50.0
#: A worker keeps at most so many words at once.
MOST_WORDS = 500_000
#: Tokens that a worker holds at once.
MOST_TOKENS = 2_000_000
END = b""  # no word is empty


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


#: Stands for the end where texts are cut into words together: no byte of UTF-8.
MARK = b"\xff"


def flat_tokens(found: list[bytes]) -> list[bytes]:
    """tokens() of all these texts, one after the other, with MARK for the end."""
    whole = b" \xff ".join([*found, b""])
    if whole.count(MARK) > len(found):  # a string that isn't UTF-8
        return flat_tokens([x.decode("utf-8", "replace").encode() for x in found])
    return whole.lower().split()


class Slots(dict):
    """Numbers words by when they were met, and MARK by 0: one look at each token, known or not."""

    def __init__(self) -> None:
        self[MARK] = 0

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self)
        return slot

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def since(self, slot: int) -> list[bytes]:
        """The words from a slot on, with the end as it is."""
        return [w if w != MARK else END for w in itertools.islice(self, slot, None)]


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def classes_of(words: list[bytes]) -> np.ndarray:
    """class_of() of each word; an ending that many have is hashed once."""
    kinds = {x: class_of(x) for x in {w[-3:] for w in words}}
    return np.array([kinds[w[-3:]] for w in words], np.int64)


def class_of(word: bytes) -> int:
    return xxhash.xxh32_intdigest(word[-3:]) & (CLASSES - 1)


class Model(NamedTuple):
    hashes: np.ndarray  # of the known words, ascending
    places: np.ndarray  # their places by descending count
    log_counts: np.ndarray  # log10(c+1), by place
    classes: np.ndarray  # by place
    core: int  # places below this have emissions of their own; the last CLASSES rows are the classes
    totals: np.ndarray  # of each class, the sum of c+1 over its words that aren't core
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # (core + CLASSES, states)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Rows of ``emits`` from numbers of words."""
        kind = np.where(codes < 0, -1 - codes, self.classes[np.maximum(codes, 0)] if len(self.classes) else 0)
        return np.where((codes >= 0) & (codes < self.core), codes, self.core + kind).astype(np.int32)


class Index:
    """The numbers of words: places of known words, -1 - class of others; those met lately are kept."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray) -> None:
        self.hashes, self.places = hashes, places
        self.clear()

    def clear(self) -> None:
        self.slots, self.own, self.codes = Slots(), np.zeros(0, np.int64), np.zeros(0, np.int32)  # by slot: hashes and numbers

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The numbers of flat_tokens(), their hashes, and which are ends."""
        at = self.slots.of(words)
        if len(self.codes) < len(self.slots):
            new = self.slots.since(len(self.codes))
            h, place = hashes_of(new), -1 - classes_of(new)
            if len(self.hashes):
                near = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                place = np.where(self.hashes[near] == h, self.places[near], place)
            self.own, self.codes = np.concatenate([self.own, h]), np.concatenate([self.codes, place.astype(np.int32)])
        out = self.codes[at], self.own[at], at == 0
        if len(self.slots) > MOST_WORDS:
            self.clear()
        return out


def by_length(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order from long to short, the symbols by (step, sequence), and how many go on at each step."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    steps = np.zeros((sizes[0], len(sizes)), np.int32)
    for i, k in enumerate(order):
        steps[: sizes[i], i] = sequences[k]
    return order, steps, np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")


def expected(sequences: list[np.ndarray], first: np.ndarray, inside: np.ndarray, start: np.ndarray, moves: np.ndarray, emits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch's E-step over parts of texts: counts of starts (of parts that are ``first``), moves and emissions.

    inside: (parts, 2), the places from and up to which a part's tokens count; the rest is there for what it says about them.
    """
    states = len(start)
    order, steps, active = by_length(sequences)
    size, many = steps.shape
    whole = stationary(moves).astype(np.float32)
    start, moves, emits = (x.astype(np.float32) for x in (start, moves, emits))
    before = np.where(first[order][:, None], start, whole)
    t = np.arange(size)[:, None]
    counts = (t >= inside[order, 0]) & (t < inside[order, 1])
    alpha, scale = np.zeros((size, many, states), np.float32), np.ones((size, many, 1), np.float32)
    for t in range(size):
        n = active[t]
        now = (before if t == 0 else alpha[t - 1, :n] @ moves) * emits[steps[t, :n]]
        scale[t, :n] = now.sum(axis=1, keepdims=True)
        alpha[t, :n] = now / scale[t, :n]
    beta = np.ones((many, states), np.float32)
    pairs = np.zeros((states, states))
    for t in range(size - 1, -1, -1):
        n = active[t]
        if t:
            after = beta[:n] * emits[steps[t, :n]] / scale[t, :n]
            pairs += (alpha[t - 1, :n] * counts[t, :n, None]).T @ after
        alpha[t, :n] *= beta[:n]
        if t:
            beta[:n] = after @ moves.T
    starts = alpha[0, first[order]].sum(axis=0, dtype=np.float64)
    symbols, gamma = steps[counts], alpha[counts]
    out = np.stack([np.bincount(symbols, gamma[:, k], len(emits)) for k in range(states)], axis=1)
    return starts, pairs * moves, out


def stationary(moves: np.ndarray) -> np.ndarray:
    """The states' long-run shares."""
    power = moves
    for _ in range(12):
        power = power @ power
    return power[0] / power[0].sum()


def maximised(starts: np.ndarray, pairs: np.ndarray, emitted: np.ndarray, unigram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities from expected counts, with priors that leave none at zero."""
    start = (starts + 0.5) / (starts + 0.5).sum()
    moves = (pairs + 0.1) / (pairs + 0.1).sum(axis=1, keepdims=True)
    emits = emitted + PRIOR * unigram[:, None]
    return start, moves, emits / emits.sum(axis=0)


def first_guess(follows: np.ndarray, firsts: np.ndarray, states: int, rounds: int = GUESS_ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, moves and (states, classes) emissions, fitted to how often one class follows another, and comes first.

    The states of two neighbours are the latent part; expectation and maximisation in turn, from a guess that stays in a state.
    """
    rng = np.random.default_rng(7)
    follows = follows + 1e-6
    shares = follows.sum(axis=1) / follows.sum()
    emits = shares * rng.gamma(4.0, 0.25, (states, len(shares)))
    emits /= emits.sum(axis=1, keepdims=True)
    joint = (np.eye(states) * 20 + 1) / (states * (states + 20))
    for _ in range(rounds):
        ratio = follows / np.maximum(emits.T @ joint @ emits, 1e-300)
        left, right = emits * (joint @ emits @ ratio.T), emits * (joint.T @ emits @ ratio)
        joint = joint * (emits @ ratio @ emits.T) + 1e-3
        emits = left + right + 1e-3 * shares
        joint, emits = joint / joint.sum(), emits / emits.sum(axis=1, keepdims=True)
    moves = joint / joint.sum(axis=1, keepdims=True)
    own = emits * joint.sum(axis=1, keepdims=True)
    start = (own / own.sum(axis=0)) @ (firsts + 1e-6)
    return start / start.sum(), moves, emits


def segments(sequences: list[np.ndarray], size: int = SEGMENT, context: int = CONTEXT) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Parts of texts with context, which are a text's first, and which of their places count."""
    cut, first, inside = [], [], []
    for s in sequences:
        for i in range(0, len(s), size):
            a = max(0, i - context)
            cut.append(s[a : i + size + context])
            first.append(i == 0)
            inside.append((i - a, min(i + size, len(s)) - a))
    return cut, np.array(first, bool), np.array(inside, np.int64).reshape(-1, 2)


def _summed(sequences: list[np.ndarray], start: np.ndarray, moves: np.ndarray, emits: np.ndarray, at_once: int = 1024) -> list:
    cut, first, inside = segments(sequences)
    total = [np.zeros(emits.shape[1]), np.zeros_like(moves, dtype=np.float64), np.zeros(emits.shape)]
    order = np.argsort([-len(x) for x in cut], kind="stable")
    for i in range(0, len(cut), at_once):
        some = order[i : i + at_once]
        for j, x in enumerate(expected([cut[k] for k in some], first[some], inside[some], start, moves, emits)):
            total[j] = total[j] + x
    return total


def log10_likelihood(sequences: list[np.ndarray], start: np.ndarray, moves: np.ndarray, emits: np.ndarray) -> np.ndarray:
    """The forward recursion over whole sequences, scaled at each step."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([sequences[k] for k in order])
    offsets = np.concatenate(([0], np.cumsum(sizes[order])[:-1]))
    active = np.searchsorted(-sizes[order], -np.arange(sizes[order[0]]), side="left")
    total = np.zeros(len(sizes))
    now = None
    for t, n in enumerate(active.tolist()):
        now = (start if t == 0 else now[:n] @ moves) * emits[flat[offsets[:n] + t]]
        scale = now.sum(axis=1)
        now /= scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(sizes))
    out[order] = total
    return out


#: Rows of corpus_counts() that aren't words: cells of how classes follow each other, and classes of first tokens.
FOLLOWS, FIRSTS = -1, -2


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(h, cls, n): the counts of all tokens of ``docs`` (text) by hash and class, and with them those of FOLLOWS and FIRSTS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, kinds, counts = Slots(), np.zeros(0, np.int64), np.zeros(0, np.int64)  # the last two by slot
        follows, firsts = np.zeros(GUESS * GUESS, np.int64), np.zeros(GUESS, np.int64)

        def rows(h: np.ndarray, cls: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(cls, pa.int32()), pa.array(n)], ["h", "cls", "n"])

        def out() -> pa.RecordBatch:
            some = np.flatnonzero(counts)
            return rows(hashes_of(places.since(0))[some] if len(some) else some, kinds[some], counts[some])

        for batch in slices(batches):
            at = places.of(flat_tokens(texts(batch)))
            if len(kinds) < len(places):
                kinds = np.concatenate([kinds, classes_of(places.since(len(kinds)))])
                counts = np.concatenate([counts, np.zeros(len(places) - len(counts), np.int64)])
            counts += np.bincount(at, minlength=len(counts))
            kind = (kinds & (GUESS - 1))[at]
            ends = at == 0
            firsts += np.bincount(kind[np.concatenate(([True], ends[:-1]))], minlength=GUESS)
            follows += np.bincount((kind[:-1] * GUESS + kind[1:])[~ends[:-1]], minlength=GUESS * GUESS)
            if len(places) > MOST_WORDS:
                yield out()
                places, kinds, counts = Slots(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield out()
        for which, sums in ((FOLLOWS, follows), (FIRSTS, firsts)):
            at = np.flatnonzero(sums)
            yield rows(at.astype(np.int64), np.full(len(at), which), sums[at])

    return docs.select("text").mapInArrow(run, "h long, cls int, n long").groupBy("h", "cls").agg(F.sum("n").alias("n"))


def _octave(n: Column) -> Column:
    """Counts by eighths of an octave: few enough for a histogram of any corpus."""
    return F.floor(F.log2(n) * 8).cast("int")


def known_words(counts: DataFrame, known: int) -> Column:
    """Which words' counts go to the workers: the most frequent ones by eighths of an octave, at most ``known``."""
    cut, have = 1 << 20, 0
    for octave, words in sorted(((r["o"], r["count"]) for r in counts.where("cls >= 0").groupBy(_octave(F.col("n")).alias("o")).count().collect()), reverse=True):
        if have + words > known:
            break
        cut, have = octave, have + words
    return (F.col("cls") >= 0) & (_octave(F.col("n")) >= cut)


def untrained(counts: DataFrame, top: Column, states: int, core: int) -> tuple[Model, np.ndarray, int, int]:
    """The model of the first guess; the corpus's share of each symbol; all training tokens, and distinct ones."""
    by_class = counts.where("cls >= 0").groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("words")).toArrow()
    at, sums, words = (by_class[c].to_numpy() for c in ("cls", "n", "words"))
    totals = np.zeros(CLASSES)
    totals[at] = sums + words
    cells = counts.where("cls < 0").toArrow()
    follows, firsts = np.zeros(GUESS * GUESS), np.zeros(GUESS)
    for which, into in ((FOLLOWS, follows), (FIRSTS, firsts)):
        own = cells["cls"].to_numpy() == which
        into[cells["h"].to_numpy()[own]] = cells["n"].to_numpy()[own]
    some = counts.where(top).toArrow()
    h, c, kind = (some[x].to_numpy() for x in ("h", "n", "cls"))
    by_count = np.lexsort((h, -c))
    h, c, kind = h[by_count], c[by_count], kind[by_count].astype(np.int32)
    core = min(core, len(c))
    totals -= np.bincount(kind[:core], c[:core] + 1.0, CLASSES)
    unigram = np.concatenate([c[:core] + 1.0, totals + 1.0])
    unigram /= unigram.sum()
    by_hash = np.argsort(h, kind="stable")
    start, moves, guessed = first_guess(follows.reshape(GUESS, GUESS), firsts, states)
    groups = np.concatenate([kind[:core], np.arange(CLASSES)]) & (GUESS - 1)
    lean = guessed[:, groups] / np.bincount(groups, unigram, GUESS)[groups]
    start, moves, emits = maximised(start * 10, moves * 1000, (unigram * lean).T * max(1, int(sums.sum())), unigram)
    return Model(h[by_hash], by_hash.astype(np.int32), np.log10(c + 1.0), kind, core, totals, start, moves, emits), unigram, int(sums.sum()), int(words.sum())


def numbered(docs: DataFrame, model: Broadcast, key: str) -> DataFrame:
    """(uid, doc_id, held_out, codes, rare): each text's words by number, and the hashes of those that aren't known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of(key, model.value)
        uid = TaskContext.get().partitionId() << 36
        for batch in slices(batches):
            codes, hashes, last = index(flat_tokens(texts(batch)))
            ends = np.concatenate([[0], np.flatnonzero(last) + 1])
            some = np.flatnonzero(codes < 0)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(some, ends), pa.int32()), pa.array(hashes[some]))
            columns = [pa.array(np.arange(uid, uid + batch.num_rows)), batch["doc_id"], batch["held_out"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(codes)), lists]
            uid += batch.num_rows
            yield pa.RecordBatch.from_arrays(columns, ["uid", "doc_id", "held_out", "codes", "rare"])

    return docs.mapInArrow(run, "uid long, doc_id long, held_out boolean, codes array<int>, rare array<long>")


_indexes: dict[str, Index] = {}


def index_of(key: str, model: Model) -> Index:
    """The worker's own index of a model's words, kept from task to task."""
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(model.hashes, model.places)
    return _indexes[key]


def gathered(batches: Iterator[pa.RecordBatch], most: int = MOST_TOKENS) -> Iterator[pa.RecordBatch]:
    """Batches of rows with about ``most`` codes, or one row: enough texts at once for each step of a recursion."""
    held, size = [], 0
    for batch in batches:
        sizes = batch["codes"].value_lengths().to_numpy(zero_copy_only=False)
        start = 0
        for i, n in enumerate(sizes.tolist()):
            if size + n > most and (held or i > start):
                part = [*held, batch.slice(start, i - start)]
                yield pa.Table.from_batches(part).combine_chunks().to_batches()[0]
                held, size, start = [], 0, i
            size += n
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a batch, and where each row's begin and the last end."""
    flat = batch["codes"].flatten().to_numpy()
    return flat, np.concatenate(([0], np.cumsum(batch["codes"].value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)


def _round(train: DataFrame, model: Broadcast) -> tuple:
    """One round's expected counts over all of ``train`` (codes)."""
    states = len(model.value.start)
    names = [f"k{i}" for i in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        total = None
        for batch in gathered(batches):
            flat, ends = _codes(batch)
            got = _summed(np.split(m.symbols(flat), ends[1:-1]), m.start, m.moves, m.emits)
            total = got if total is None else [a + b for a, b in zip(total, got, strict=True)]
        if total is not None:
            starts, pairs, emitted = total
            some = np.flatnonzero(emitted.sum(axis=1))
            rows = np.vstack([emitted[some], pairs, starts[None]])
            keys = np.concatenate([some, -1 - np.arange(states + 1)])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(pa.array(c, pa.float32()) for c in rows.T)], ["w", *names])

    rows = train.select("codes").mapInArrow(run, "w long, " + ", ".join(f"{k} float" for k in names))
    sums = rows.groupBy("w").agg(*[F.sum(k).alias(k) for k in names]).toArrow()
    keys, values = sums["w"].to_numpy(), np.stack([sums[k].to_numpy() for k in names], axis=1)
    emitted = np.zeros(model.value.emits.shape)
    emitted[keys[keys >= 0]] = values[keys >= 0]
    rest = np.zeros((states + 1, states))
    rest[-1 - keys[keys < 0]] = values[keys < 0]
    return rest[states], rest[:states], emitted


def trained(train: DataFrame, model: Model, unigram: np.ndarray, rounds: int = ROUNDS) -> Model:
    """The model after ``rounds`` of Baum-Welch over all rows of ``train`` (codes)."""
    for _ in range(rounds):
        sent = train.sparkSession.sparkContext.broadcast(model)
        start, moves, emits = maximised(*_round(train, sent), unigram)
        model = model._replace(start=start, moves=moves, emits=emits)
        sent.unpersist()
    return model


def scores(docs: DataFrame, fold: int = 7, held: int = 2, states: int = STATES, core: int = CORE, known: int = KNOWN, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``."""
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), (crc % fold == held).alias("held_out"))
    counts = table(corpus_counts(rows.where("NOT held_out")), "counts")
    top = known_words(counts, known)
    model, unigram, n_all, distinct = untrained(counts, top, states, core)
    words = spark.sparkContext.broadcast(model._replace(emits=None))
    texts_ = table(numbered(rows, words, uuid.uuid4().hex), "codes")
    model = trained(texts_.where("NOT held_out"), model, unigram, rounds if n_all else 0)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        log_counts, log_totals = np.append(m.log_counts, 0.0), np.log10(m.totals + 1)
        for batch in gathered(batches):
            flat, ends = _codes(batch)
            symbols = m.symbols(flat)
            logs = log_counts[np.where(flat < 0, -1, flat)]
            # Within its class, another word has its own count's share.
            others = np.where(symbols < m.core, 0.0, logs - log_totals[np.maximum(symbols - m.core, 0)])
            forward = log10_likelihood(np.split(symbols, ends[1:-1]), m.start, m.moves, m.emits)
            of = lambda x: np.add.reduceat(x, ends[:-1])
            columns = [batch["uid"], batch["doc_id"], batch["held_out"], pa.array(np.diff(ends)), pa.array(of((flat >= 0).astype(np.int64))), pa.array(of(logs)), pa.array(forward + of(others))]
            yield pa.RecordBatch.from_arrays(columns, ["uid", "doc_id", "held_out", "n_tokens", "n_known", "logs", "path"])

    part = texts_.select("uid", "doc_id", "held_out", "codes").mapInArrow(run, "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, path double")
    rare = texts_.select("uid", F.explode("rare").alias("h")).join(counts.where(F.col("cls") >= 0).where(~top), "h")
    sums = rare.groupBy("uid").agg(F.sum(F.log10(F.col("n") + 1)).alias("rare_logs"), F.count("*").alias("rare_known"))
    all_ = part.join(table(sums, "rare"), "uid", "left").fillna(0, ["rare_logs", "rare_known"])
    return all_.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * math.log10(n_all + distinct + 1)).alias("base_score"),
        (F.col("path") + F.col("rare_logs")).alias("score"),
    )


def op3_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
