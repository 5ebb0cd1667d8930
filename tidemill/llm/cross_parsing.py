"""Language identification by cross-parsing: suffix automata of labelled text, and the fewest phrases wins.

Each language's automaton knows every substring of a sample of its text. A text is read from left to right into phrases, each the
longest that stands somewhere in the sample (Ziv and Merhav, 1993); a language that a text is written in has long matches, so few
phrases. What is compared is phrases * log2(size of the sample) / symbols: bits a symbol, so that samples of other sizes can be compared.

Symbols are bytes of lower-case UTF-8; digits, spaces, punctuation and controls of ASCII are one space, however many stand together.
Whole texts are parsed, in sections of ``SECTION`` symbols that are parsed on their own, so that many are stepped through at once.

Learning is bounded, whatever the size of the corpus: ``SAMPLE_DOCS`` documents of each language chosen by a hash of their identifiers, of
these ``SAMPLE_BYTES`` bytes of whole lines chosen by a hash, equal lines once, fewer where ``TABLE_CELLS`` would not hold the automata of all
languages. Of languages, the ``MOST_LANGS`` with the most labelled documents are learnt. Only these samples and tables meet on the driver.

Null texts and texts without a letter are ``und`` with score 0; letters that no sample has count for no language, and ties go to the
least name. Without labelled text everything is ``und``. Repeated rows and ids are scored each for themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import slices, texts

UNKNOWN = "und"
#: Documents of a language that its sample comes from, bytes of lines in it, and the longest document and line that are taken.
SAMPLE_DOCS, SAMPLE_BYTES, LONGEST_DOC, LONGEST_LINE = 512, 48 << 10, 1 << 20, 4 << 10
MOST_LANGS = 256
#: Entries of all automata's tables together, four bytes each.
TABLE_CELLS = 32 << 20
SECTION = 1024
#: Sections that are stepped through at once.
LANES = 4096

_PLAIN = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
_LETTER = regex.compile(r"\p{L}")
_COST = 28
_MASK = (1 << _COST) - 1


def symbols(text: bytes) -> bytes:
    """Lower case; all of ASCII that is no letter is one space."""
    low = text.lower() if text.isascii() else text.decode().lower().encode()
    return b" ".join(low.translate(_PLAIN).split())


class SuffixAutomaton:
    """The automaton of a string's substrings (Blumer et al., 1985), built symbol by symbol."""

    def __init__(self, text: bytes) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        last = 0
        for c in text:
            last = self._extend(last, c)

    def _extend(self, last: int, c: int) -> int:
        new, p = self._state(self.len[last] + 1, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        elif self.len[p] + 1 == self.len[q := self.next[p][c]]:
            self.link[new] = q
        else:
            twin = self._state(self.len[p] + 1, dict(self.next[q]))
            self.link[twin] = self.link[q]
            self.link[q] = self.link[new] = twin
            while p >= 0 and self.next[p].get(c) == q:
                self.next[p][c] = twin
                p = self.link[p]
        return new

    def _state(self, size: int, step: dict[int, int]) -> int:
        self.next.append(step)
        self.link.append(0)
        self.len.append(size)
        return len(self.next) - 1

    def phrases(self, text: bytes) -> int:
        """How many phrases ``text`` is parsed into, one step at a time; a symbol that isn't known is a phrase."""
        n = state = 0
        for c in text:
            if c in self.next[state]:
                state = self.next[state][c]
            elif c in self.next[0]:
                n, state = n + 1, self.next[0][c]
            else:
                n, state = n + 1 + (state > 0), 0
        return n + (state > 0)


@dataclass(frozen=True)
class Model:
    """All languages' automata as one table: a row for each state, a column for each known symbol and one for all others.

    An entry is the row that follows (times the columns), and above ``_COST`` bits how many phrases end there.
    """

    langs: list[str]
    bits: np.ndarray  # log2 of each sample's size
    columns: np.ndarray  # a symbol's column
    width: int
    starts: np.ndarray  # each language's first entry
    table: np.ndarray

    def parse(self, sections: list[bytes]) -> np.ndarray:
        """How many phrases each section has in each language: [languages, sections]."""
        sizes = np.fromiter(map(len, sections), np.int64, len(sections))
        order = np.argsort(-sizes, kind="stable")
        longest = int(sizes.max())
        rows = b"".join(sections[i].ljust(longest, b"\0") for i in order)
        steps = np.ascontiguousarray(self.columns[np.frombuffer(rows, np.uint8).reshape(len(sections), longest)].T)
        active = len(sections) - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")
        state = np.repeat(self.starts[:, None], len(sections), axis=1)
        count = np.zeros(state.shape, np.int32)
        for t in range(longest):
            m = int(active[t])
            to = self.table[state[:, :m] + steps[t, :m]]
            count[:, :m] += to >> _COST
            state[:, :m] = to & _MASK
        count += state != self.starts[:, None]
        out = np.empty_like(count)
        out[:, order] = count
        return out


def _table(text: bytes, columns: np.ndarray, width: int) -> np.ndarray:
    """One automaton's rows, with states from 0."""
    made = SuffixAutomaton(text)
    first = made.next[0]
    # Where a match ends, the next phrase starts with the symbol; unknown ones are phrases of their own.
    restart = np.full(width, 2 << _COST, np.int32)
    for c, to in first.items():
        restart[columns[c]] = to * width | 1 << _COST
    table = np.repeat(restart[None], len(made.next), axis=0)
    table[0, (restart >> _COST) == 2] = 1 << _COST
    for state, step in enumerate(made.next):
        for c, to in step.items():
            table[state, columns[c]] = to * width
    return table


def _share(of: Column, *more: Column) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(13), of, *more), 11)).cast("double") / float(1 << 53)


def learn(docs: DataFrame) -> Model:
    """A model from doc_id, text and lang of ``docs``, of rows whose text and lang aren't null; see above for the bounds."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGS)
    # Twice the wanted share, as a hash's counts vary; what is over goes by rank.
    some = known.where(F.octet_length("text") <= LONGEST_DOC).join(F.broadcast(counts), "lang").where(_share(F.col("doc_id")) * F.col("n") < 2 * SAMPLE_DOCS)
    ranked = some.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(_share(F.col("doc_id")), "text"))).where(F.col("k") <= SAMPLE_DOCS)
    lines = ranked.select("lang", F.explode(F.split("text", "\n")).alias("line")).where(F.octet_length("line") <= LONGEST_LINE).distinct()
    upto = F.sum(F.octet_length("line") + 1).over(Window.partitionBy("lang").orderBy(_share(F.col("line")), "line"))
    taken = lines.withColumn("upto", upto).where(F.col("upto") <= SAMPLE_BYTES).drop("upto")

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        own = sorted(symbols(x.encode()) for x in rows["line"])
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "sample": [b" ".join(x for x in own if x)]})

    samples = {r["lang"]: bytes(r["sample"]) for r in taken.groupBy("lang").applyInPandas(joined, "lang string, sample binary").collect() if r["sample"]}
    return model(samples)


def model(samples: dict[str, bytes]) -> Model:
    langs = sorted(samples)
    seen = sorted({c for x in samples.values() for c in x})
    columns = np.full(256, len(seen), np.int32)
    columns[seen] = np.arange(len(seen))
    width = len(seen) + 1
    # An automaton has at most two states for each symbol.
    most = TABLE_CELLS // (2 * width * max(1, len(langs)))
    tables, starts, at = [], [], 0
    for x in langs:
        made = _table(samples[x][:most], columns, width)
        tables.append((made + at).ravel())
        starts.append(at)
        at += made.size
    bits = np.array([log2(max(2, min(most, len(samples[x])))) for x in langs])
    return Model(langs, bits, columns, width, np.array(starts, np.int32), np.concatenate(tables) if tables else np.zeros(0, np.int32))


def predictions(made: Model, rows: list[bytes]) -> tuple[list[str], list[float]]:
    """Each text's language and how sure it is: the runner-up's bits of both's bits, 0.5 for a tie."""
    langs, scores = [UNKNOWN] * len(rows), [0.0] * len(rows)
    phrases, size = np.zeros((len(made.langs), len(rows))), np.zeros(len(rows))
    sections: list[bytes] = []
    owners: list[int] = []

    def flush() -> None:
        np.add.at(phrases.T, owners, made.parse(sections).T)
        sections.clear()
        owners.clear()

    for i, x in enumerate(rows):
        if not made.langs or not _LETTER.search(x.decode()):
            continue
        own = symbols(x) or b" "
        size[i] = len(own)
        for k in range(0, len(own), SECTION):
            sections.append(own[k : k + SECTION])
            owners.append(i)
            if len(sections) == LANES:
                flush()
    if sections:
        flush()
    for i in np.flatnonzero(size):
        bits = phrases[:, i] * made.bits / size[i]
        best = int(np.argmin(bits))
        langs[i] = made.langs[best]
        second = float(np.min(np.delete(bits, best))) if len(bits) > 1 else 0.0
        scores[i] = second / (second + float(bits[best])) if len(bits) > 1 else 1.0
    return langs, scores


def identify(docs: DataFrame, made: Model, text: str = "text", name: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language of each text and its score; columns of these names are replaced."""
    docs = docs.drop(name, score)
    sent = docs.sparkSession.sparkContext.broadcast(made)  # of a bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            langs, scores = predictions(sent.value, texts(batch, text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, name, score])

    schema = docs.withColumns({name: F.lit("").cast("string"), score: F.lit(0.0)}).schema
    return docs.mapInArrow(run, schema)


def op13_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learnt from those whose crc32(doc_id) mod 4 isn't 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    made = learn(docs.where("NOT held_out").select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "held_out", "text"), made).drop("text")
