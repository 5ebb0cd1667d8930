"""Hard negatives by a pivot table: brackets of scores from stored distances, and exact checks of what they leave.

A row's score for an anchor is their inner product. Rows get one more coordinate, sqrt(M^2 - |x|^2) with M the longest row, and anchors a 0
there: then d^2 = |q|^2 + M^2 - 2 q.x, so that higher scores are smaller Euclidean distances. Distances of all rows to ``PIVOTS`` rows are stored;
by the triangle inequality |d(q, p) - d(x, p)| <= d(q, x) <= d(q, p) + d(x, p), which brackets the score of a row for an anchor without
their product. Rows whose bracket can't reach an anchor's fifth best (of its label), or lies outside all its positives' bands, go; the
others' scores are taken exactly. Brackets are widened by ``SLACK`` of their size, so that rounding loses no row.

Anchors against all rows are blocks against blocks: ``ROWS`` rows and ``ANCHORS`` anchors meet in a task, both dealt by a hash of the
identifier, and only each anchor's first few of a block leave it. Nothing is broadcast; the pivots and M are one small row.

Rows with a null id, label or vector, or a component that is null or not finite, take no part. Of rows of one vec_id the least by label and
vector takes part. Components become floor(256 x); shorter vectors count as ending in zeros. Products are exact in doubles up to 2^53,
in 64-bit integers above; no table of the size that 64 bits can't hold has a defined result. Positives with a negative score have no
band, so no negatives. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import table

PIVOTS, PIVOT_SAMPLE = 8, 256
ROWS, ANCHORS = 1024, 1024
POSITIVES, NEGATIVES = 5, 3
SLACK = 1e-9


def usable(df: DataFrame, vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """vec_id, label and v (integers) of the rows that take part."""
    x = F.col(vector)
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")) & ~F.isnan(c.cast("double")))
    own = F.col("label").cast("long") if label is None else label
    rows = df.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), own.alias("label"), F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long")).alias("v"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _dot(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact products of integers: in doubles where no sum can pass 2^53."""
    most = float(np.sqrt((q.astype(float) ** 2).sum(1).max(initial=0)) * np.sqrt((x.astype(float) ** 2).sum(1).max(initial=0)))
    return (q.astype(float) @ x.astype(float).T).astype(np.int64) if most < 2**52 else q @ x.T


def _pivots(sample: np.ndarray, square: float) -> np.ndarray:
    """Augmented rows that lie far from each other, the first with the longest own part."""
    if not len(sample):
        return np.zeros((0, sample.shape[1] + 1))
    rows = np.c_[sample, np.sqrt(np.maximum(square - (sample**2).sum(1), 0))]
    chosen = [int(np.argmax((sample**2).sum(1)))]
    near = np.full(len(rows), np.inf)
    while len(chosen) < min(PIVOTS, len(rows)):
        near = np.minimum(near, ((rows - rows[chosen[-1]]) ** 2).sum(1))
        chosen.append(int(np.argmax(near)))
    return rows[chosen]


class PivotTable:
    """A table of vectors with their distances to the pivots, and what is needed to bracket scores with these."""

    def __init__(self, vectors: DataFrame) -> None:
        self.spark = vectors.sparkSession
        held = table(vectors, "vectors")
        v = F.col("v").cast("array<double>")
        square = F.aggregate(v, F.lit(0.0), lambda a, c: a + c * c)
        one = held.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % 50 == 0).alias("anchors"), F.max(F.size("v")).alias("width"), F.max(square).alias("square")).first()
        self.n, self.width, self.square = one["n"], one["width"] or 0, one["square"] or 0.0
        first = held.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("v").toPandas()
        self.pivots = _pivots(_matrix(first["v"], self.width).astype(float), self.square)
        self.row_blocks, self.anchor_blocks = -(-self.n // ROWS) or 1, -(-one["anchors"] // ANCHORS) or 1
        pivots, most, width = self.pivots, self.square, self.width

        def distances(parts):
            for df in parts:
                x = _matrix(df["v"], width).astype(float)
                own = (x**2).sum(1)
                rows = np.c_[x, np.sqrt(np.maximum(most - own, 0))]
                # A pivot's square with its last coordinate, and a row's, are both M^2.
                d = np.sqrt(np.maximum(2 * most - 2 * rows @ pivots.T, 0))
                yield df.assign(to_row=list(d), to_anchor=list(np.sqrt(np.maximum(own[:, None] + most - 2 * x @ pivots[:, :-1].T, 0))))

        measured = held.mapInPandas(distances, "vec_id long, label long, v array<long>, to_row array<double>, to_anchor array<double>")
        block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
        self.rows = table(measured.withColumn("rb", block(self.row_blocks)), "pivot-distances")
        self.anchors = self.rows.where("vec_id % 50 = 0").withColumn("ab", block(self.anchor_blocks)).select(*[F.col(c).alias(c) for c in (*self.rows.columns, "ab")])

    def meet(self, anchors: DataFrame, find, schema: str) -> DataFrame:
        """What ``find`` makes of each block of anchors beside each block of rows."""
        count = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        right = self.rows.drop("to_anchor").withColumn("ab", count(self.anchor_blocks))
        left = anchors.drop("to_row", "rb").withColumn("rb", count(self.row_blocks))
        left = left.select(*[F.col(c).alias(c) for c in left.columns])  # both sides come of one table: names of their own
        return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab")).applyInPandas(find, schema)

    def brackets(self, to_anchor: np.ndarray, to_row: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score of each row for each anchor that the distances allow."""
        near = np.zeros((len(to_anchor), len(to_row)))
        far = np.full(near.shape, np.inf)
        gap, reach = np.empty_like(near), np.empty_like(near)
        for j in range(to_row.shape[1]):
            np.subtract(to_anchor[:, j, None], to_row[None, :, j], out=gap)
            np.maximum(near, np.abs(gap, out=gap), out=near)
            np.minimum(far, np.add(to_anchor[:, j, None], to_row[None, :, j], out=reach), out=far)
        whole = (norms + self.square)[:, None]
        slack = SLACK * (whole + 1)
        return (whole - far**2) / 2 - slack, (whole - near**2) / 2 + slack


class _Bounds:
    """What a task needs of the table, without its frames."""

    def __init__(self, of: PivotTable) -> None:
        self.square, self.width = of.square, of.width

    brackets = PivotTable.brackets


def _blocks(a: pd.DataFrame, r: pd.DataFrame, of: _Bounds):
    """Both sides as arrays, the rows by ascending vec_id."""
    r = r.sort_values("vec_id")
    ids, labels, x = r["vec_id"].to_numpy(), r["label"].to_numpy(), _matrix(r["v"], of.width)
    return ids, labels, x, np.stack(r["to_row"]), a["vec_id"].to_numpy(), a["label"].to_numpy(), _matrix(a["v"], of.width), np.stack(a["to_anchor"])


def positives(of: PivotTable) -> DataFrame:
    """anchor_id, positive_id, positive_score: each anchor's first other rows of its label."""
    bounds = _Bounds(of)

    def find(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = {"anchor_id": [], "positive_id": [], "positive_score": []}
        if len(a) and len(r):
            ids, labels, x, to_row, who, own, q, to_anchor = _blocks(a, r, bounds)
            for label in np.unique(own):
                cols, lines = np.flatnonzero(labels == label), np.flatnonzero(own == label)
                if not len(cols):
                    continue
                least, most = bounds.brackets(to_anchor[lines], to_row[cols], (q[lines].astype(float) ** 2).sum(1))
                other = ids[cols][None, :] != who[lines][:, None]
                # So many rows reach at least this, so none that stays below it can be among the first.
                k = min(POSITIVES + 1, len(cols))
                floor = np.partition(np.where(other, least, -np.inf), len(cols) - k, axis=1)[:, len(cols) - k]
                stay = other & (most >= floor[:, None])
                some = np.flatnonzero(stay.any(0))
                scores = _dot(q[lines], x[cols[some]])
                order = np.argsort(np.where(stay[:, some], -scores, np.iinfo(np.int64).max), axis=1, kind="stable")[:, :POSITIVES]
                good = np.take_along_axis(stay[:, some], order, 1)
                out["anchor_id"].append(np.repeat(who[lines], good.sum(1)))
                out["positive_id"].append(ids[cols[some]][order][good])
                out["positive_score"].append(np.take_along_axis(scores, order, 1)[good])
        return pd.DataFrame({k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()})

    found = of.meet(of.anchors, find, "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("k", F.row_number().over(first)).where(F.col("k") <= POSITIVES).drop("k")


def negatives(of: PivotTable, wanted: DataFrame) -> DataFrame:
    """For each anchor and positive the first rows of other labels with 50 p <= 100 n <= 95 p."""
    bounds = _Bounds(of)

    def find(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = {k: [] for k in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")}
        if len(a) and len(r):
            ids, labels, x, to_row, who, own, q, to_anchor = _blocks(a, r, bounds)
            bands = [np.array([(p["positive_score"], p["positive_id"]) for p in ps], np.int64).reshape(-1, 2) for ps in a["wanted"]]
            least, most = bounds.brackets(to_anchor, to_row, (q.astype(float) ** 2).sum(1))
            high, low = np.array([int(b[:, 0].max()) * 95 // 100 for b in bands]), np.array([-(-b[:, 0].min() // 2) for b in bands])
            stay = (labels[None, :] != own[:, None]) & (least <= high[:, None]) & (most >= low[:, None])
            some = np.flatnonzero(stay.any(0))
            if len(some):
                scores = _dot(q, x[some])
                # What doesn't stay or is over the band of the best positive sorts last.
                keys = np.where(stay[:, some] & (scores <= high[:, None]) & (scores >= low[:, None]), -scores, np.iinfo(np.int64).max)
                for i, band in enumerate(bands):
                    near = np.flatnonzero(keys[i] != np.iinfo(np.int64).max)
                    if not len(near):
                        continue
                    near = near[np.argsort(keys[i][near], kind="stable")]
                    falling = keys[i][near]
                    for p, positive in band.tolist():
                        at = int(np.searchsorted(falling, -(p * 95 // 100)))
                        own_ = near[at : at + NEGATIVES]
                        own_ = own_[scores[i, own_] >= -(-p // 2)]
                        n = len(own_)
                        for name, v in (("anchor_id", who[i]), ("positive_id", positive), ("positive_score", p)):
                            out[name].append(np.full(n, v, np.int64))
                        out["negative_id"].append(ids[some[own_]])
                        out["negative_score"].append(scores[i, own_])
        return pd.DataFrame({k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()})

    bands = wanted.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("wanted"))  # at most POSITIVES
    anchors = of.anchors.join(bands, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    found = of.meet(anchors, find, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(embeddings: DataFrame, vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    of = PivotTable(usable(embeddings, vector, label))
    return negatives(of, table(positives(of), "positives"))


def op12_pivot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=changed)


OP12_SQL = """
WITH rows_ AS (
  SELECT * FROM (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
good AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT * FROM (
  SELECT g.anchor_id, g.positive_id, CAST(row_number() OVER (PARTITION BY g.anchor_id, g.positive_id ORDER BY p.score DESC, p.id) AS INTEGER) AS rank, p.id AS negative_id, g.positive_score, p.score AS negative_score
  FROM good g JOIN pairs p ON p.anchor_id = g.anchor_id AND NOT p.same AND 50 * g.positive_score <= 100 * p.score AND 100 * p.score <= 95 * g.positive_score) WHERE rank <= 3
"""
