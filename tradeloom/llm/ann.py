"""Nearest neighbours by inner product: a block matrix join over int8 tiles with error bounds.

Vectors are cut into panels. A tile multiplies the int8 codes of a panel of queries with
those of a panel of candidates; quantisation error bounds tell which pairs can still be
among the nearest, and only those are computed in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.common import stage, table

NEIGHBOURS = 20
QUERY_STEP = 20
QUERIES_PER_PANEL = 256
CANDIDATES_PER_PANEL = 2048
# float32 sums of products of int8 codes are exact up to this many dimensions.
EXACT_DIMENSIONS = 1024
# Surviving pairs whose vectors are gathered at a time.
PAIRS_AT_ONCE = 1 << 14
# Norms for which neither bounds nor scores leave the range of doubles. Pairs of others are always computed.
LEAST_NORM, MOST_NORM = 1e-120, 1e140


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, their scales, the norm of what the codes miss, and the norm of the vectors.

    A vector whose norm is out of range has codes of 0 and misses everything: its norms are infinite.
    """
    with np.errstate(over="ignore", under="ignore"):
        norm = np.sqrt((vectors**2).sum(axis=1))
    usual = (norm > LEAST_NORM) & (norm < MOST_NORM)
    vectors = np.where(usual[:, None], vectors, 0.0)
    scale = np.where(usual, np.abs(vectors).max(axis=1) / 127.0, 1.0)
    codes = np.rint(vectors / scale[:, None])
    missed = np.sqrt(((vectors - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes.astype(np.int8), scale, np.where(usual, missed, np.inf), np.where(usual, norm, np.inf)


def tile_bounds(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Approximate inner products of a tile and a bound on their errors.

    With x = sx*cx + rx and y = sy*cy + ry, <x,y> - sx*sy*<cx,cy> = <rx,y> + <sx*cx,ry>,
    which is at most |rx||y| + (|x| + |rx|)|ry|.
    """
    qc, qs, qm, qn = quantise(queries)
    cc, cs, cm, cn = quantise(candidates)
    products = np.zeros((len(qc), len(cc)))
    for start in range(0, qc.shape[1], EXACT_DIMENSIONS):
        part = slice(start, start + EXACT_DIMENSIONS)
        products += qc[:, part].astype(np.float32) @ cc[:, part].astype(np.float32).T
    products *= qs[:, None] * cs[None, :]
    with np.errstate(invalid="ignore"):
        error = qm[:, None] * cn[None, :] + (qn + qm)[:, None] * cm[None, :]
        # for the rounding of this arithmetic itself
        error += 1e-12 * (qn[:, None] * cn[None, :])
    # vectors out of range rule nothing out and are never ruled out
    error[np.isinf(qn)] = np.inf
    error[:, np.isinf(cn)] = np.inf
    return products, error


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in the order of the dimensions, so that equal vectors tie exactly."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def order_of(scores: np.ndarray) -> np.ndarray:
    """What scores are ordered by: those that are no number (sums of both infinities) are the smallest."""
    return np.where(np.isnan(scores), -np.inf, scores)


def nearest_in_tile(
    query_rows: np.ndarray, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and scores of every query's `k` nearest candidates of the tile, its own row left out, and their number.

    The first two are (queries, k), nearest first; of fewer candidates the last places are void.
    """
    products, error = tile_bounds(queries, candidates)
    own = query_rows[:, None] == rows[None, :]
    lower = np.where(own, -np.inf, products - error)
    upper = np.where(own, -np.inf, products + error)
    if len(ids) > k:
        # at least k candidates reach the k-th largest lower bound
        floor = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
    else:
        floor = np.full(len(query_rows), -np.inf)
    at, other = np.nonzero((upper >= floor[:, None]) & ~own)
    scores = np.empty(len(at))
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        for start in range(0, len(at), PAIRS_AT_ONCE):
            part = slice(start, start + PAIRS_AT_ONCE)
            scores[part] = inner_products(queries[at[part]], candidates[other[part]])
    order = np.lexsort((ids[other], -order_of(scores), at))
    at, other, scores = at[order], other[order], scores[order]
    rank = np.arange(len(at)) - np.searchsorted(at, np.arange(len(query_rows)))[at]
    kept = rank < k
    best_ids = np.zeros((len(query_rows), k), dtype=np.int64)
    best_scores = np.zeros((len(query_rows), k))
    best_ids[at[kept], rank[kept]] = ids[other[kept]]
    best_scores[at[kept], rank[kept]] = scores[kept]
    return best_ids, best_scores, np.bincount(at[kept], minlength=len(query_rows))


class Heaps:
    """The best `k` of every query of a panel, merged from the lists of its tiles."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        # (order, -id, score), the worst on top
        self.heaps: list[list[tuple[float, int, float]]] = [[] for _ in query_ids]
        self.worst = np.full(len(query_ids), -np.inf)

    def add(self, ids: np.ndarray, scores: np.ndarray, found: np.ndarray) -> None:
        order = order_of(scores)
        for q, i in zip(*np.nonzero((order >= self.worst[:, None]) & (np.arange(self.k) < found[:, None]))):
            heap, entry = self.heaps[q], (float(order[q, i]), -int(ids[q, i]), float(scores[q, i]))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.k:
                self.worst[q] = heap[0][0]

    def rows(self) -> list[tuple[int, int, int, float]]:
        return [
            (int(query), rank, -negative, score)
            for query, heap in zip(self.query_ids, self.heaps)
            for rank, (_, negative, score) in enumerate(sorted(heap, key=lambda e: e[:2], reverse=True), 1)
        ]


def usable_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`row, vec_id`, the vector in doubles as `values`, and its length as `width`, stored.

    `row` numbers the rows; rows that share an id are vectors of their own. Vectors that are null, empty, zero
    or hold null or non-finite components, and rows without an id, take no part. Vectors are compared with
    those of their own length. Other columns are left out, so their names cannot clash.
    """
    values = F.col(vector).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = df.filter(F.col(id_column).isNotNull() & F.coalesce(fine, F.lit(False)))
    kept = kept.filter(F.exists(vector, lambda x: x != 0))
    taken = kept.select(F.col(id_column).cast("bigint").alias("vec_id"), values.alias("values"), F.size(vector).alias("width"))
    # the numbers hold because they are written once, with the rows
    return stage(taken.withColumn("row", F.monotonically_increasing_id()), "vectors")


PANEL = "width int, panel bigint, rows binary, ids binary, vectors binary"


def _panels(rows: DataFrame, size: int) -> DataFrame:
    """Pack vectors into rows of up to `size` vectors; row numbers, ids and vectors as raw 8-byte values."""
    columns = [c.split()[0] for c in PANEL.split(", ")]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_rows: dict[tuple[int, int], list] = {}

        def row(key: tuple[int, int], found: list) -> tuple:
            numbers, ids = (np.array([f[i] for f in found], dtype=np.int64).tobytes() for i in (0, 1))
            return (*key, numbers, ids, np.array([f[2] for f in found], dtype=np.float64).tobytes())

        for batch in batches:
            out = []
            for number, vec_id, values, width, panel in batch.itertuples(index=False, name=None):
                found = open_rows.setdefault((width, panel), [])
                found.append((number, vec_id, values))
                if len(found) >= size:
                    out.append(row((width, panel), open_rows.pop((width, panel))))
            yield pd.DataFrame(out, columns=columns)
        rest = [row(key, found) for key, found in open_rows.items()]
        yield pd.DataFrame(rest, columns=columns)

    dealt = rows.select("row", "vec_id", "values", "width", "panel").repartition("width", "panel")
    return dealt.mapInPandas(pack, PANEL)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    queries_per_panel: int = QUERIES_PER_PANEL,
    candidates_per_panel: int = CANDIDATES_PER_PANEL,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: every query's `k` vectors with the largest inner product.

    Both sides come from the same `usable_vectors`; every row but the query's own is a candidate, also rows of its
    id. Queries that share an id have a list each. All pairs of a query panel and a candidate panel
    meet as one tile of the grid, so a task's memory is bounded by two panels. Tiles give
    exact results: a pair is dropped only if its upper bound is below the `k`-th lower
    bound of its query; where numbers leave the range of the bounds, it is always computed. The lists of the tiles
    are merged by a heap per query. Ties go to the smaller id. Scores may overflow to infinities; one that is no
    number comes last. No queries or no candidates give no rows.
    """
    n_candidates, n_queries = vectors.count(), queries.count()
    columns, rows = ceil(n_candidates / candidates_per_panel), ceil(n_queries / queries_per_panel)
    spark = vectors.sparkSession
    shape = "query_id bigint, rank int, vec_id bigint, score double"
    if not columns or not rows:
        return spark.createDataFrame([], shape)
    spot = F.xxhash64("row")
    # a panel number is a hash bucket, so panels hold about the size asked for
    candidates = _panels(vectors.withColumn("panel", F.pmod(spot, F.lit(columns))), 2 * candidates_per_panel)
    asked = _panels(queries.withColumn("panel", F.pmod(spot, F.lit(rows))), 2 * queries_per_panel)
    left = asked.select(
        "width", F.col("rows").alias("query_rows"), F.col("ids").alias("query_ids"), F.col("vectors").alias("queries"),
        F.col("panel").alias("row"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(columns - 1).cast("bigint"))).alias("column"),
    )
    right = candidates.withColumnRenamed("panel", "column")
    tiles = left.join(right, ["width", "column"])
    tiles = tiles.select("row", "width", "query_rows", "query_ids", "queries", "rows", "ids", "vectors")
    names = ["row", "width", "query_rows", "query_ids", "ids", "scores", "found"]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, width, query_rows, query_ids, query_values, rows, ids, values in batch.itertuples(index=False, name=None):
                best_ids, best_scores, found = nearest_in_tile(
                    np.frombuffer(query_rows, dtype=np.int64),
                    np.frombuffer(query_values, dtype=np.float64).reshape(-1, width),
                    np.frombuffer(rows, dtype=np.int64),
                    np.frombuffer(ids, dtype=np.int64),
                    np.frombuffer(values, dtype=np.float64).reshape(-1, width),
                    k,
                )
                lists = (best_ids.tobytes(), best_scores.tobytes(), found.astype(np.int64).tobytes())
                yield pd.DataFrame([(row, width, query_rows, query_ids, *lists)], columns=names)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The lists of a query panel come one after the other."""
        heaps, current = None, None
        columns = ["query_id", "rank", "vec_id", "score"]
        for batch in batches:
            for row, width, query_rows, query_ids, ids, scores, found in batch[names].itertuples(index=False, name=None):
                if (row, width, query_rows) != current:
                    if heaps:
                        yield pd.DataFrame(heaps.rows(), columns=columns)
                    current, heaps = (row, width, query_rows), Heaps(np.frombuffer(query_ids, dtype=np.int64), k)
                heaps.add(
                    np.frombuffer(ids, dtype=np.int64).reshape(-1, k),
                    np.frombuffer(scores, dtype=np.float64).reshape(-1, k),
                    np.frombuffer(found, dtype=np.int64),
                )
        if heaps:
            yield pd.DataFrame(heaps.rows(), columns=columns)

    lists = tiles.mapInPandas(solve, "row bigint, width int, query_rows binary, query_ids binary, ids binary, scores binary, found binary")
    merged = lists.repartition("row", "width").sortWithinPartitions("row", "width", "query_rows").mapInPandas(merge, shape)
    # pandas hands over what is no number as NULL
    return merged.withColumn("score", F.coalesce("score", F.lit(float("nan"))))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all other vectors."""
    vectors = usable_vectors(table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.filter(F.col("vec_id") % QUERY_STEP == 0))


OP1_SQL = f"""
WITH fine AS (
  SELECT row_number() OVER () AS place, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id,
         list_reduce(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]), lambda a, b: a + b) AS score
  FROM fine q JOIN fine c ON q.place <> c.place AND len(q.v) = len(c.v)
  WHERE q.vec_id % {QUERY_STEP} = 0
), ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY place ORDER BY CASE WHEN isnan(score) THEN '-infinity'::DOUBLE ELSE score END DESC, vec_id) AS rank
  FROM pairs
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {NEIGHBOURS}
"""
