"""Exact top-k search by inner product with a pivot table.

Every vector keeps its distances to a set of pivots. For a query q and a candidate x the largest difference of
their distances to a pivot is a lower bound of their distance, and with the lengths of both it gives an upper
bound of the inner product: (|q|^2 + |x|^2 - bound^2) / 2. Candidates are taken in order of that bound and
scored exactly until no bound left reaches the k-th best score, so nothing that belongs to the result is
passed over. A bound that equals the k-th score is still evaluated, for ties go to the smaller id.

The pivot table is written once. Queries come in blocks of bounded size: one block at a time goes to every
task, each task keeps the best k of its rows per query, and the tasks' lists are merged by query. Work grows
with queries x rows, as an exact answer to every query must; memory does not.

Components become floor(256 * x). Results: vectors that are null, or hold a null or non-finite component, take
no part, and neither do those with a component of 2^20 or more in size, whose scores would not fit a long.
Vectors are compared with vectors of the same length only. Repeated candidate rows count each; a repeated
query row is asked once; a query never finds rows of its own id. Rows without id take no part. An empty
vector scores 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reqlytics.llm.common import chosen, mapped, materialise
from reqlytics.sources.warehouse import scratch_root

PIVOTS = 32
#: Queries held by a task at once.
BLOCK_QUERIES = 2048
#: Candidates bounded at once, and scored at once in bound order.
CHUNK, STEP = 2048, 64
LIMIT = float(1 << 20)


def whole_numbers(vector: Column) -> Column:
    """floor(256 * x) of each component."""
    return F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))


def is_usable(vector: Column) -> Column:
    """No null, NaN or infinite component, and none beyond the limit."""
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LIMIT)
    )


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    rows = df.select(df[f"`{vec_id}`"].cast("long").alias("vec_id"), df[f"`{vector}`"].alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & is_usable(F.col("v"))).select(
        "vec_id", whole_numbers(F.col("v")).alias("v")
    )


def choose_pivots(rows: DataFrame, n: int = PIVOTS) -> dict[int, np.ndarray]:
    """``n`` vectors of each length that is common among ``4 n`` of them: bounded, the same on every run.

    A length without pivots is searched by vector lengths alone, which is exact too."""
    found: dict[int, list[list[int]]] = {}
    for row in chosen(rows, "vec_id", 4 * n).collect():
        found.setdefault(len(row["v"]), []).append(row["v"])
    return {size: np.array(vs[:n], np.float64).reshape(len(vs[:n]), size) for size, vs in found.items()}


def distances(vectors: np.ndarray, pivots: np.ndarray | None) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    if pivots is None or not len(pivots):
        return np.zeros((len(vectors), 1))
    squares = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * (vectors @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def pivot_table(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``vec_id``, ``v`` and ``d``, the distances to the pivots of that length."""
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("v", T.ArrayType(T.LongType())),
            T.StructField("d", T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, part in by_length(batch, 1):
                found = distances(matrix(part.column(1), size), pivots.get(size))
                offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1])
                listed = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), listed], names=schema.names)

    return mapped(rows, run, schema)


def by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.diff(batch.column(column).offsets.to_numpy())
    for size in np.unique(lengths).tolist():
        same = lengths == size
        yield size, batch if same.all() else batch.filter(pa.array(same))


class Best:
    """The best k (score, id) of each query so far: larger scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.scores.shape[1]
        scores = np.concatenate([self.scores[query], scores])
        ids = np.concatenate([self.ids[query], ids])
        order = np.lexsort((ids, ~scores))[:k]  # ~ turns the order round, for the smallest value too
        self.scores[query], self.ids[query] = scores[order], ids[order]


def search_chunk(queries: dict, best: Best, ids: np.ndarray, vectors: np.ndarray, dists: np.ndarray) -> None:
    """Enter the candidates of a chunk that can be among the best k of any query."""
    own_squares = (vectors.astype(np.float64) ** 2).sum(1)
    gap = np.zeros((len(queries["ids"]), len(ids)))
    for p in range(dists.shape[1]):
        np.maximum(gap, np.abs(queries["d"][:, p : p + 1] - dists[None, :, p]), out=gap)
    # distances are rounded: a hair is taken off, so that the bound stays above the product
    largest = max(float(own_squares.max(initial=0)), float(queries["squares"].max(initial=0)))
    gap = np.maximum(gap - 1e-6 * np.sqrt(largest), 0)
    bound = (queries["squares"][:, None] + own_squares[None, :] - gap**2) / 2
    bound += 1e-9 * largest + 1e-3
    open_ = bound >= best.scores[:, -1:]
    for query in np.flatnonzero(open_.any(1)).tolist():
        at = np.flatnonzero(open_[query])
        order = at[np.argsort(-bound[query, at], kind="stable")]
        for first in range(0, len(order), STEP):
            part = order[first : first + STEP]
            kth = best.scores[query, -1]
            if bound[query, part[0]] < kth:
                break
            scores = vectors[part] @ queries["v"][query]
            good = (scores >= kth) & (ids[part] != queries["ids"][query])
            if good.any():
                best.add(query, scores[good], ids[part[good]])


def search_block(table: DataFrame, block, k: int) -> DataFrame:
    """The best k of every task for every query of a broadcast block."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("place", "query_id", "vec_id", "score")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value
        best = {size: Best(len(q["ids"]), k) for size, q in queries.items()}
        for batch in batches:
            for size, part in by_length(batch, 1):
                if size not in queries:
                    continue
                ids, vectors = part.column(0).to_numpy(), matrix(part.column(1), size)
                dists = matrix(part.column(2), queries[size]["d"].shape[1])
                for a in range(0, len(ids), CHUNK):
                    search_chunk(queries[size], best[size], ids[a : a + CHUNK], vectors[a : a + CHUNK], dists[a : a + CHUNK])
        for size, found in best.items():
            query, rank = np.nonzero(found.ids < np.iinfo(np.int64).max)
            if len(query):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(queries[size]["places"][query]),
                        pa.array(queries[size]["ids"][query]),
                        pa.array(found.ids[query, rank]),
                        pa.array(found.scores[query, rank]),
                    ],
                    names=schema.names,
                )

    return mapped(table, run, schema)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    n_pivots: int = PIVOTS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the best k of all rows for the rows where ``is_query``.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = df.sparkSession
    rows = usable(df, vec_id, vector)
    table = materialise(pivot_table(rows, choose_pivots(rows, n_pivots)), "pivots")
    asked = table.where(is_query).distinct()
    n = asked.count()
    blocks = -(-2 * n // block_queries) if n > block_queries else 1  # half full on average, as the split is by hash
    out = f"{scratch_root(spark)}/top_k"
    schema = T.StructType(
        [T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("vec_id", "score")]
    )
    spark.createDataFrame([], schema).write.parquet(out)
    for number in range(blocks):
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == number)
        held: dict[int, dict] = {}
        for place, row in enumerate(part.collect()):  # one block of queries
            q = held.setdefault(len(row["v"]), {"places": [], "ids": [], "v": [], "d": []})
            for name, value in (("places", place), ("ids", row["vec_id"]), ("v", row["v"]), ("d", row["d"])):
                q[name].append(value)
        for size, q in held.items():
            q["places"], q["ids"] = np.array(q["places"], np.int64), np.array(q["ids"], np.int64)
            q["v"] = np.array(q["v"], np.int64).reshape(len(q["ids"]), size)
            q["d"], q["squares"] = np.array(q["d"], np.float64), (q["v"].astype(np.float64) ** 2).sum(1)
        sent = spark.sparkContext.broadcast(held)
        found = search_block(table, sent, k).groupBy("place", "query_id").agg(
            F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("low"), "vec_id"))), 1, k).alias("best")
        )
        best = found.select("query_id", F.posexplode("best").alias("at", "hit"))
        best.select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("hit.vec_id").alias("vec_id"),
            (-F.col("hit.low")).alias("score"),
        ).write.mode("append").parquet(out)
        sent.unpersist()
    return spark.read.schema(schema).parquet(out)
