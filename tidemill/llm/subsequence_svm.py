"""Toxicity by a support vector machine with a subsequence string kernel (Lodhi et al., 2002).

The kernel of two words counts the three-letter subsequences that they share, gaps allowed:
one that spans n letters of a word weighs ``DECAY`` ** n there, and the kernel is
normalised. So letters put into an insult ("id.iot", "i-d-i-o-t") lower its likeness only a little.
Words are what stands between ASCII white space, lower-cased, without the marks at their ends,
between two end marks; single letters in a row are joined ("i d i o t"); words of over
``WIDE`` letters go through in windows that overlap by half.

Training (on the driver, on at most ``SAMPLE`` labelled texts of each label and ``SAMPLE_BYTES`` in all, whole texts): a
text is labelled, its words are not, so the machine starts from words that stand in several
toxic texts, near copies counted once, and in hardly any other, learns, and in a further round takes as counter-examples the
clean texts' words that it likes best. In the ``LATENT`` rounds after that the examples are the labelled texts' sentences:
each sentence of a clean text, and of a toxic text the one that the machine likes best, stands for its best word, with the
label of its text (a latent support vector machine). The feature map is Nystroem's: kernel values to
``LANDMARKS`` words, times the inverse root of the landmarks' own kernel matrix; on it a
linear machine is trained (squared hinge loss). As such a machine is a weighted sum of
kernels to the landmarks, it is folded into one table of weights by three-letter
subsequence, which gives the same values exactly. A text's margin is its best words'
margins, and a logistic curve, fitted on the training texts, makes the score of them.

Labels of 0 and 1 for one doc_id cancel out. No column but the text is an input of the score. Null is the empty text; texts without words
have the lowest margin. Without both labels to learn from, all scores are 0.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import append, give_back, holds, slices, texts

DECAY, WIDE, LETTERS, MARK = 0.6, 20, 128, 2
SAMPLE, LANDMARKS, NEGATIVES, ROUNDS, COST = 2000, 320, 2500, 2, 30.0
SAMPLE_BYTES = 64 << 20
#: A worker keeps at most so many words' margins at once: half of them those met lately, half those met before.
MOST_WORDS = 200_000
#: Words of one length whose subsequences are looked up at once.
AT_ONCE = 4096
THRESHOLD = 0.7

#: Rounds in which labelled sentences are the examples; a toxic text whose best word is below FAR has no insult that is known.
LATENT, FAR = 2, -0.5
_STRIP = re.compile(rb"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$").sub
_ENDS = re.compile(rb"(?<=[.!?])\s+|\n+")
_SPACES = re.compile(rb"(?<![^\t-\r ])[A-Za-z](?:[\t-\r ]+[A-Za-z](?![^\t-\r ])){3,}")


def code_of(c: str) -> int:
    """A letter's class: 1 is an end, MARK any mark, then a to z, digits, and others by code point."""
    if "a" <= c <= "z":
        return ord(c) - 94
    if "0" <= c <= "9":
        return ord(c) - 19
    return 39 + ord(c) % (LETTERS - 39) if c.isalnum() else MARK


def words(text: bytes) -> list[bytes]:
    """The words of a text as they stand; single letters in a row become one more word."""
    found = text.split()
    if _SINGLES in np.minimum(np.fromiter(map(len, found), np.int64, len(found)), 2).astype(np.uint8).tobytes():
        found += [b"".join(m[0].split()) for m in _SPACES.finditer(text)]
    return found


#: Four words of one letter in a row.
_SINGLES = b"\1" * 4
#: The class of each character of ASCII; what isn't a letter or digit is a mark, and a space stays apart from them.
_CLASSES = bytes([code_of(chr(c).lower()) if c != 32 else 0 for c in range(128)]) + bytes(128)


def letters(of: list[bytes]) -> list[bytes]:
    """The classes of the letters of each of these words, without the marks at its ends."""
    plain = [w if w.isascii() else b"" for w in of]
    found = [w.strip(b"\2") for w in b" ".join(plain).translate(_CLASSES).split(b"\0")]
    for i, w in enumerate(of):
        if not plain[i] and w:
            s = w.decode("utf-8", "replace").lower()
            a, b = 0, len(s)
            while a < b and not s[a].isalnum():
                a += 1
            while b > a and not s[b - 1].isalnum():
                b -= 1
            found[i] = bytes(map(code_of, s[a:b]))
    return found


def windows(found: bytes) -> list[bytes]:
    """What letters() gives, between end marks and in windows."""
    if not found:
        return []
    codes = b"\1%b\1" % found
    if len(codes) <= WIDE:
        return [codes]
    return [codes[i : i + WIDE] for i in range(0, len(codes) - WIDE // 2, WIDE // 2)]


def coded(word: bytes) -> list[list[int]]:
    """The windows of a word as classes of letters between end marks."""
    return [[*w] for w in windows(letters([word])[0])]


class _Threes(NamedTuple):
    places: np.ndarray  # (subsequences, 3)
    weights: np.ndarray


_threes: dict[int, _Threes] = {}


def threes(n: int) -> _Threes:
    """All places of three letters in a word of ``n``, and their weights."""
    if n not in _threes:
        places = np.array(list(combinations(range(n), 3)), np.int32).reshape(-1, 3)
        _threes[n] = _Threes(places, (DECAY ** (places[:, 2] - places[:, 0] - 2)).astype(np.float32))
    return _threes[n]


def keys_of(batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length, each three-letter subsequence as a number; and the weights."""
    places, weights = threes(batch.shape[1])
    b = batch.astype(np.int32)
    return (b[:, places[:, 0]] * LETTERS + b[:, places[:, 1]]) * LETTERS + b[:, places[:, 2]], weights


def _marked(keys: np.ndarray) -> np.ndarray:
    """Which subsequences have a mark in them; a mark only makes a gap."""
    return (keys // LETTERS**2 == MARK) | (keys // LETTERS % LETTERS == MARK) | (keys % LETTERS == MARK)


class Vector(NamedTuple):
    """A word's normalised features: subsequences, ascending, and their values."""

    keys: np.ndarray
    values: np.ndarray


def features(word: list[int]) -> Vector:
    keys, weights = keys_of(np.array([word]))
    keep = ~_marked(keys[0])
    unique, at = np.unique(keys[0][keep], return_inverse=True)
    values = np.bincount(at, weights[keep])
    return Vector(unique.astype(np.int32), (values / max(np.sqrt((values**2).sum()), 1e-12)).astype(np.float32))


def norms(batch: np.ndarray) -> np.ndarray:
    """Of words of one length, each one's feature vector's length: the kernel of a word and itself, letter by letter."""
    count, n = batch.shape
    alike = ((batch[:, :, None] == batch[:, None]) & (batch != MARK)[:, :, None]).astype(np.float32)
    gap = np.arange(n)[None] - np.arange(n)[:, None]
    after = np.where(gap > 0, DECAY ** np.maximum(gap, 0), 0).astype(np.float32)
    ends = alike
    for _ in range(2):  # one letter more, in either word after what it has
        for _ in range(2):
            ends = (ends.reshape(-1, n) @ after).reshape(count, n, n).swapaxes(1, 2)
        ends = ends * alike
    return np.sqrt(np.maximum(ends.sum(axis=(1, 2)) / DECAY**4, 1e-12))


class Model(NamedTuple):
    key: str
    table: np.ndarray  # the folded weights, by subsequence
    bias: float
    curve: np.ndarray  # the logistic curve's weights of (1, best, second best, share of good words)


class Scorer:
    """Margins of words and texts; keeps those of words met lately."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.met: dict[bytes, float] = {}
        self.before: dict[bytes, float] = {}

    def _raw(self, batch: np.ndarray) -> np.ndarray:
        """The table's weights of all subsequences of words of one length, summed."""
        out, columns = np.zeros(len(batch), np.float32), np.ascontiguousarray(batch.T).astype(np.intp)
        n = len(columns)
        decay = (DECAY ** np.arange(n)).astype(np.float32)
        for i in range(n - 2):
            first = columns[i] * LETTERS
            for j in range(i + 1, n - 1):
                keys = columns[j + 1 :] + (first + columns[j]) * LETTERS
                out += decay[j - i - 1 : n - i - 2] @ self.model.table.take(keys, mode="clip")
        return out

    def margins(self, new: list[bytes]) -> list[float]:
        """The best window's margin of each word; what has no positive part is at the bias."""
        found = letters(new)
        forms = dict.fromkeys(found)
        by_size: dict[int, tuple[list, list]] = {}
        for i, form in enumerate(forms):
            forms[form] = i
            for w in windows(form):
                own = by_size.setdefault(len(w), ([], []))
                own[0].append(w)
                own[1].append(i)
        out = np.full(len(forms), self.model.bias, np.float32)
        for size, (some, of) in by_size.items():
            batch, of = np.frombuffer(b"".join(some), np.uint8).reshape(-1, size), np.array(of)
            raw = np.concatenate([self._raw(batch[a : a + AT_ONCE]) for a in range(0, len(batch), AT_ONCE)])
            good = np.flatnonzero(raw > 0)
            for part in (good[a : a + AT_ONCE // 4] for a in range(0, len(good), AT_ONCE // 4)):
                np.maximum.at(out, of[part], raw[part] / norms(batch[part]) + self.model.bias)
        return out[np.array([*map(forms.__getitem__, found)], np.intp)].tolist()

    def _values(self, flat: list[bytes]) -> list[float]:
        """Each word's margin. Words are kept in two halves: when the newer one is full, what wasn't met again in its time goes."""
        own = {*flat}
        new = own.difference(self.met)
        if new:
            if len(self.met) + len(new) > MOST_WORDS // 2:
                self.before, self.met, new = self.met, {}, own
            again = new.intersection(self.before)
            self.met.update(zip(again, map(self.before.__getitem__, again), strict=True))
            new = [*new.difference(again)]
            self.met.update(zip(new, self.margins(new), strict=True))
        return list(map(self.met.__getitem__, flat))

    def __call__(self, found: list[bytes]) -> np.ndarray:
        """(1, best, second best, share of good words) of each text."""
        lists = [words(x) for x in found]
        values = np.array(self._values([w for x in lists for w in x]), np.float32)
        out = np.zeros((len(found), 4))
        out[:, 0], out[:, 1:3] = 1, self.model.bias
        sizes = np.array([len(x) for x in lists], np.int64)
        some = np.flatnonzero(sizes)
        if not len(some):
            return out
        starts = (np.cumsum(sizes) - sizes)[some]
        out[some, 1] = np.maximum.reduceat(values, starts)
        out[some, 3] = np.log1p(np.add.reduceat(values > 0, starts, dtype=np.int64))
        # The second best: without the first place of the best.
        best = np.flatnonzero(values == np.repeat(out[some, 1].astype(np.float32), sizes[some]))
        of = np.searchsorted(starts, best, "right") - 1
        values[best[np.unique(of, return_index=True)[1]]] = -np.inf
        out[some, 2] = np.maximum(np.maximum.reduceat(values, starts), np.where(sizes[some] > 1, np.float32(self.model.bias), -np.inf))
        out[some[sizes[some] == 1], 2] = self.model.bias
        return out


def probability(x: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton's method; the rarer label weighs more by the root of how much rarer it is. But for the first, no weight is under 0: a
    worse word never makes a text better."""
    ones, zeros = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    weight = np.where(y == 1, (zeros / ones) ** 0.5, 1.0)
    free = np.ones(x.shape[1], bool)
    while True:
        own, w = x[:, free], np.zeros(x.shape[1])
        for _ in range(rounds):
            p = probability(x, w)
            gradient = own.T @ (weight * (p - y)) + penalty * w[free]
            w[free] -= np.linalg.solve((own.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ own + penalty * np.eye(free.sum()), gradient)
        if (w[1:] >= 0).all():
            return w
        free[1 + int(np.argmin(w[1:]))] = False


def linear_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = COST, rounds: int = 30) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by Newton's method on the points within the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        a, t = x[inside], weight[inside] * c
        new = np.linalg.solve((a.T * t) @ a + np.eye(len(w)), a.T @ (t * y[inside]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def _matrix(a: list[Vector], b: list[Vector]) -> np.ndarray:
    """Kernel values of words (as features) a and b."""
    table, out = np.zeros(LETTERS**3, np.float32), np.zeros((len(a), len(b)))
    flat, values = np.concatenate([x.keys for x in a]), np.concatenate([x.values for x in a])
    row = np.repeat(np.arange(len(a)), [len(x.keys) for x in a])
    for j, x in enumerate(b):
        table[x.keys] = x.values
        out[:, j] = np.bincount(row, values * table[flat], len(a))
        table[x.keys] = 0
    return out


def with_gaps(word: bytes, rng: np.random.Generator) -> list[bytes]:
    """The word with marks or letters put into it: what the kernel is to tolerate."""
    s = word.decode("utf-8", "replace")
    if len(s) < 4:
        return []
    at = int(rng.integers(2, len(s) - 1))
    return [(s[:at] + "." + s[at:]).encode(), "-".join(s).encode(), (s[:at] + s[at - 1] + s[at:]).encode()]


def unlike(sets: list[set[bytes]], rng: np.random.Generator, bands: int = 5, rows: int = 6) -> list[int]:
    """Of texts with nearly the same words, the first: copies of a text aren't more evidence about its words."""
    odd = rng.integers(0, 2**62, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    seen: set[tuple] = set()
    out = []
    for i, s in enumerate(sets):
        h = np.fromiter((xxhash.xxh64_intdigest(w) for w in s), np.uint64, len(s))
        with np.errstate(over="ignore"):
            least = (h[:, None] * odd[None]).min(axis=0).reshape(bands, rows).tolist() if len(s) else [[0]]
        marks = {(b, *x) for b, x in enumerate(least)}
        if not marks & seen:
            out.append(i)
        seen |= marks
    return out


def train(found: list[bytes], y: np.ndarray, landmarks: int = LANDMARKS, rounds: int = ROUNDS, seed: int = 5) -> Model:
    """Fit on whole texts and their labels (0 or 1)."""
    rng = np.random.default_rng(seed)
    key = uuid.uuid4().hex
    same: dict[bytes, bytes] = {}  # one object for each word, however many texts have it

    def stripped(x: bytes) -> set[bytes]:
        own = {_STRIP(b"", w).decode("utf-8", "replace").lower().encode() for w in words(x)} - {b""}
        return {same.setdefault(w, w) for w in own}

    sets = [stripped(x) for x in found]
    kept = unlike(sets, rng)
    found, sets, y = [found[i] for i in kept], [sets[i] for i in kept], y[kept]
    bad, good = Counter(), Counter()
    for s, label in zip(sets, y, strict=True):
        (bad if label else good).update(s)
    n_bad, n_good = int((y == 1).sum()), int((y == 0).sum())
    # How much more often toxic texts have a word: the log-likelihood ratio, and its direction.
    ratio = {}
    for w, k in bad.items():
        m = good[w]
        rate = (k + m) / (n_bad + n_good)
        if k >= 2 and k / n_bad > 4 * m / n_good:
            ratio[w] = 2 * (k * np.log(k / n_bad / rate) + (m * np.log(m / n_good / rate) if m else 0))
    seeds = [w for w, v in sorted(ratio.items(), key=lambda x: (-x[1], x[0])) if v > 25][:800]
    if not seeds or not n_good:
        return Model(key, np.zeros(LETTERS**3, np.float32), -1.0, np.array([-30.0, 0, 0, 0]))
    pool = sorted(good)
    common = [w for w, _ in sorted(good.items(), key=lambda x: (-x[1], x[0]))[: NEGATIVES // 2]]
    clean = [*dict.fromkeys([*common, *(pool[i] for i in rng.permutation(len(pool))[:NEGATIVES])])][:NEGATIVES]
    spoiled = [x for w in seeds[:200] for x in with_gaps(w, rng)]
    positive, negative = [*seeds, *spoiled], clean
    half = landmarks // 2
    marks = [*seeds[:half], *clean[:half]]
    model = None
    known: dict[bytes, list[Vector]] = {}

    def margins_of(model: Model, some: list[bytes]) -> np.ndarray:
        return np.concatenate([Scorer(model).margins(some[j : j + 20_000]) for j in range(0, len(some), 20_000)])

    def vectors(of: list[bytes]) -> list[Vector]:
        """A word longer than a window stands for the window that is worst by the machine so far, as in scoring."""
        for w in of:
            if w not in known:
                known[w] = [features(x) for x in coded(w) or [[1, 1]]]
        value = lambda f: 0.0 if model is None else float(f.values @ model.table[f.keys])
        return [max(known[w], key=value) if len(known[w]) > 1 else known[w][0] for w in of]

    def machine(words_: list[bytes], y_words: np.ndarray, weight: np.ndarray) -> Model:
        base = vectors(marks)
        own = _matrix(base, base)
        values, axes = np.linalg.eigh(own + 1e-6 * np.eye(len(own)))
        root = axes / np.sqrt(np.maximum(values, 1e-6))
        w, bias = linear_machine(_matrix(vectors(words_), base) @ root, y_words, weight)
        table = np.zeros(LETTERS**3, np.float32)
        for c, f in zip(root @ w, base, strict=True):
            table[f.keys] += c * f.values
        return Model(key, table, min(bias, -1e-3), np.array([-1.0, 1, 1, 0]))

    def balanced(y_words: np.ndarray) -> np.ndarray:
        up = y_words > 0
        return np.where(up, len(y_words) / 4 / max(1, up.sum()), len(y_words) / 4 / max(1, (~up).sum()))

    for i in range(rounds):
        y_words = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        model = machine([*positive, *negative], y_words, balanced(y_words))
        if i < rounds - 1:
            margins = margins_of(model, pool)
            worst = [pool[j] for j in np.argsort(-margins)[:800]]
            negative = [*dict.fromkeys([*negative, *worst])]
            marks = [*dict.fromkeys([*seeds[:half], *worst[: half // 2], *marks[half:]])][:landmarks]
    # From here on the examples are the labelled sentences: each stands for its best word by the machine so far.
    sentences, signs = [], []
    for x, own, label in zip(found, sets, y, strict=True):
        parts = [own] if label else [stripped(part) for part in _ENDS.split(x)]
        sentences += [part for part in parts if part]
        signs += [int(label)] * sum(map(bool, parts))
    everything = sorted({w for own in sentences for w in own})
    for _ in range(LATENT):
        margin = dict(zip(everything, margins_of(model, everything).tolist(), strict=True))
        best = [max(own, key=lambda w: (margin[w], w)) for own in sentences]
        up = [w for w, label in zip(best, signs, strict=True) if label and margin[w] > FAR]
        down = sorted({w for w, label in zip(best, signs, strict=True) if not label and margin[w] > -1}, key=lambda w: (-margin[w], w))[:NEGATIVES]
        y_words = np.array([1.0] * (len(up) + len(positive)) + [-1.0] * (len(down) + len(negative)))
        model = machine([*up, *positive, *down, *negative], y_words, balanced(y_words))
    scorer = Scorer(model)
    x = np.vstack([scorer(found[i : i + 200]) for i in range(0, len(found), 200)])
    return model._replace(curve=logistic(x, y.astype(float)))


_scorers: dict[str, Scorer] = {}


def scorer_of(model: Model) -> Scorer:
    """The worker's own, kept from task to task."""
    if model.key not in _scorers:
        _scorers.clear()
        _scorers[model.key] = Scorer(model)
    return _scorers[model.key]


def fitted(docs: DataFrame, labels: DataFrame, fold: int = 3, held: int = 1, sample: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> Model:
    """Train on at most ``sample`` labelled texts of each label, of rows whose crc32 mod fold isn't ``held``, and ``most_bytes`` of them.

    They are taken in the order of a hash of their doc_id, so the choice is the same however the rows are dealt. A doc_id
    with both labels is left out. Of rows that share a doc_id, each counts.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    single = marked.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").select("doc_id", "toxic")
    ours = single.where(F.crc32(F.col("doc_id").cast("string")) % fold != held)
    some = [ours.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for label in (0, 1)]
    chosen = dict(some[0].union(some[1]).collect())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")]

    def of(keys: list[int]) -> DataFrame:
        ids = spark.createDataFrame([(k,) for k in keys] or [(-1,)], "chosen long")
        return rows.join(F.broadcast(ids), F.col("doc_id") == F.col("chosen"), "left_semi")

    sizes = of([*chosen]).select("doc_id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("h")).orderBy(*order[:2], "h").limit(4 * sample).collect()
    wanted, total = set(), 0
    for r in sizes:  # a text over what is left of the bound is passed by, not the end
        if total + r["size"] <= most_bytes:
            total += r["size"]
            wanted.add((r["doc_id"], r["h"]))
    keys = spark.createDataFrame([*wanted] or [(-1, 0)], "chosen long, hash long")
    found = rows.join(F.broadcast(keys), (F.col("doc_id") == F.col("chosen")) & (F.xxhash64("text") == F.col("hash")), "left_semi").orderBy(*order).limit(4 * sample).collect()
    labelled = sorted(((r["doc_id"], r["text"].encode()) for r in found if r["doc_id"] in chosen))
    del found, sizes
    model = train([x for _, x in labelled], np.array([chosen[k] for k, _ in labelled], int))
    del labelled
    give_back()
    return model


def toxicity(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with a score for each text; no shuffle."""
    df = df.drop(name)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("toxicity", _scorers.clear)
        made = scorer_of(sent.value)
        for batch in slices(batches, text):
            yield append(batch, **{name: pa.array(probability(made(texts(batch, text)), made.model.curve))})

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))


def op1_subsequence_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = toxicity(rows, model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
