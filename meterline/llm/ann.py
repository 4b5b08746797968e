"""Nearest neighbours from balanced posting lists whose centroids are searched by a graph in memory."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterline.llm.tables import read, written


@dataclass(frozen=True)
class Centroids:
    """Unit vectors of the lists, and for each the places of its neighbours in the graph."""

    points: np.ndarray
    links: np.ndarray

    def nearest(self, x: np.ndarray, width: int, rows: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """For unit vectors x the places and cosines of about the `width` nearest centroids (all, if fewer), best first."""
        parts = [self._search(x[k : k + rows], min(width, len(self.points))) for k in range(0, len(x), rows)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search for all of x at once: the best centroid of each row not looked at yet has its links
        scored; a row ends when nothing in its beam is left to look at.
        """
        k, n = len(self.points), len(x)
        entry = np.linspace(0, k - 1, width).astype(int)
        beam = np.repeat(entry[None], n, 0)
        score = x @ self.points[entry].T
        seen = np.zeros((n, k), bool)
        seen[:, entry] = True
        opened = np.zeros((n, width), bool)
        live = np.arange(n)
        while len(live):
            order = np.argsort(-score[live], axis=1, kind="stable")
            beam[live], score[live], opened[live] = (np.take_along_axis(a[live], order, 1) for a in (beam, score, opened))
            live = live[~opened[live].all(1)]
            if not len(live):
                break
            at = np.argmin(opened[live], axis=1)
            opened[live, at] = True
            new = self.links[beam[live, at]]
            fresh = ~seen[live[:, None], new]
            seen[live[:, None], new] = True
            # a centroid that two links of one row lead to counts once
            fresh &= ~(np.tril(new[:, :, None] == new[:, None, :], -1) & fresh[:, None, :]).any(2)
            cosines = np.where(fresh, np.einsum("nd,nld->nl", x[live], self.points[new]), -np.inf)
            all_beam, all_score = np.hstack([beam[live], new]), np.hstack([score[live], cosines])
            all_open = np.hstack([opened[live], ~fresh])
            best = np.argsort(-all_score, axis=1, kind="stable")[:, :width]
            beam[live], score[live], opened[live] = (np.take_along_axis(a, best, 1) for a in (all_beam, all_score, all_open))
        return beam, score


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that nothing over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _in_blocks(x: np.ndarray, points: np.ndarray, of, rows: int = 1024) -> np.ndarray:
    """What `of` makes of the cosines of rows of x with all points, some rows at a time: no matrix of all of them is made."""
    return np.concatenate([of(x[k : k + rows] @ points.T) for k in range(0, len(x), rows)])


def balanced_centroids(sample: np.ndarray, n_lists: int, rounds: int = 12, degree: int = 24) -> Centroids:
    """k-means on unit vectors with a growing price for full lists, and the graph of nearest centroids."""
    rng = np.random.default_rng(7)
    x = unit(sample)
    n_lists = max(1, min(n_lists, len(x)))
    points = x[rng.choice(len(x), n_lists, replace=False)]
    price = np.zeros(n_lists)
    for _ in range(rounds):
        own = _in_blocks(x, points, lambda c: np.argmax(c - price, axis=1))  # noqa: B023
        sizes = np.bincount(own, minlength=n_lists)
        price += 0.02 * (sizes / max(1, len(x) / n_lists) - 1)
        sums = np.zeros_like(points)
        np.add.at(sums, own, x)
        empty = np.abs(sums).max(axis=1) < 1e-12
        sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        points = unit(sums)
    links = _in_blocks(points, points, lambda c: np.argsort(-c, axis=1, kind="stable")[:, 1 : degree + 1])
    far = rng.integers(0, n_lists, (n_lists, 4))  # some long links keep the graph in one piece
    return Centroids(points, np.hstack([links, far]))


def valid(column):
    finite = F.forall(column, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return column.isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda v: v != 0)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def exact_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision: equal rows always give equal figures."""
    scale_a, scale_b = np.abs(a).max(axis=1, keepdims=True), np.abs(b).max(axis=1, keepdims=True)
    a, b = a / scale_a, b / scale_b
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def nearest_in(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, top: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of queries: query ids, vector ids and cosines of the best `top` of x, ties to smaller ids."""
    ux = unit(x)
    for begin in range(0, len(q), 256):
        part, part_ids = q[begin : begin + 256], query_ids[begin : begin + 256]
        cosines = unit(part) @ ux.T
        cosines[part_ids[:, None] == ids[None]] = -np.inf
        least = np.partition(cosines, max(0, len(ids) - top), axis=1)[:, max(0, len(ids) - top)]
        row, at = np.nonzero((cosines >= least[:, None] - 1e-9) & np.isfinite(cosines))
        exact = exact_cosines(part[row], x[at])
        order = np.lexsort((ids[at], -exact, row))
        row, at, exact = row[order], at[order], exact[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        best = rank < top
        yield part_ids[row[best]], ids[at[best]], exact[best]


def nearest_neighbours(
    vectors: DataFrame, is_query, top: int = 5, sample_rows: int = 20_000, list_rows: int = 256, shard_rows: int = 512,
    copies: int = 4, copy_ratio: float = 1.1, probes: int = 24, probe_ratio: float = 1.6,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the `top` vectors nearest to each query row, itself left out.

    Centroids are fitted on a sample: the sample_rows vectors with the smallest hashes of vec_id. Every vector is put
    on the list of its nearest centroid and, near a boundary, on up to copies - 1 more whose distance is within
    copy_ratio of that. A query reads the lists whose distance is within probe_ratio of its nearest, at most probes of them (eight
    at least). Lists longer than shard_rows are read in shards of their own, so no list meets in one task.
    Scores are cosines of the original vectors in double precision; ties go to the smaller vec_id.

    Vectors that are null, empty, zero, hold nulls or non-finite values, or have another length than
    most of the sample take no part; nor do rows without vec_id. Repeated rows are one. Other columns are ignored; an empty table gives no rows.
    """
    named = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), is_query.alias("is_query")).where(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
    sample = named.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).toArrow()
    spark = vectors.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score double"
    if not len(sample):
        return spark.createDataFrame([], out_schema)
    lengths = np.asarray(sample["embedding"].combine_chunks().value_lengths())
    width = int(np.bincount(lengths).argmax())
    named = named.where(F.size("embedding") == width)
    total = named.count()
    fitted = balanced_centroids(_matrix(sample["embedding"].combine_chunks().filter(pa.array(lengths == width))), -(-total // list_rows))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            query = batch.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
            place, cosine = fitted.nearest(unit(_matrix(batch.column("embedding"))), probes)
            distance = np.sqrt(np.maximum(2 - 2 * cosine, 0))
            ratio = distance / np.maximum(distance[:, :1], 1e-9)
            column = np.arange(place.shape[1])
            stored = (column < copies) & (ratio <= copy_ratio) | (column == 0)
            probed = ((ratio <= probe_ratio) | (column < 8)) & query[:, None]
            for role, chosen in ((False, stored), (True, probed)):
                row, at = np.nonzero(chosen)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(place[row, at], pa.int64()), pa.array(np.full(len(row), role)), taken.column("vec_id"), taken.column("embedding")], ["list", "probe", "vec_id", "embedding"])

    element = vectors.schema["embedding"].dataType.simpleString()
    placed = written(named.mapInArrow(assign, f"list long, probe boolean, vec_id long, embedding {element}"), "posting-lists")
    shards = placed.where(~F.col("probe")).groupBy("list").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))  # a row for each centroid at most
    placed = placed.join(F.broadcast(shards), "list")
    lists = placed.where(~F.col("probe")).withColumn("shard", F.pmod(F.xxhash64("vec_id"), "shards")).select("list", "shard", "vec_id", "embedding")
    asked = placed.where("probe").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).select("list", "shard", "vec_id", "embedding").toDF("of_list", "of_shard", "query_id", "query")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(left) and len(right):
            ids, first = np.unique(left["vec_id"].to_numpy(), return_index=True)
            found += nearest_in(ids, _matrix(left["embedding"])[first], right["query_id"].to_numpy(), _matrix(right["query"]), top)
        query_ids, ids, scores = map(np.concatenate, zip(*found))
        return pa.table({"query_id": query_ids, "vec_id": ids, "score": scores})

    found = lists.groupBy("list", "shard").cogroup(asked.groupBy("of_list", "of_shard")).applyInArrow(search, "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    few = found.withColumn("rank", F.dense_rank().over(best)).where(F.col("rank") <= top)  # the same vector from two lists has one rank
    return few.distinct().select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
