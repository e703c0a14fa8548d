"""Exact top-k search by inner product, with a pivot table.

Vectors are turned into whole numbers, floor(scale * x). Some rows become pivots; the distances of every row to all pivots are
computed once and stored with the rows. For a query q and a row x, every pivot p gives |d(q, p) - d(x, p)| <= d(q, x). The largest of these lower
bounds on the distance gives an upper bound on the inner product, (|q|^2 + |x|^2 - d^2) / 2. Candidates are
evaluated in the order of their bounds, best first, until the next bound is below the k-th best score: nothing behind it can enter the
result, so it is exact.

Rows are packed into blocks. Query blocks meet candidate blocks in cells of a grid: stripes of candidates by groups of queries, each cell a
bounded amount of work. The best rows of each cell are merged per query. All arithmetic on scores is exact: float32 or float64 products where all
sums fit into their mantissa, whole numbers of any size otherwise (scores are then cut to 64 bits).

Defined results: rows with a NULL or NaN or infinite component, or a NULL vector or id, take no part. Vectors of different lengths are
filled up with zeros. Rows with the query's own id are no candidates for it. If an id repeats, its rows count as one row whose score is the best
of theirs. Ties go to the smaller id. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statforge.llm.shared import arrow_schema, checkpointed

BLOCK, QUERY_BLOCK = 1024, 256
ROWS_PER_STRIPE, QUERIES_PER_GROUP = 4096, 1024
_BLOCKS = "is_query boolean, part int, seq int, number int, kind string, ids binary, vectors binary, to_pivots binary"
_HITS = "query_id bigint, vec_id bigint, score bigint"
_HUGE = float(np.finfo(np.float64).max)


def whole(vectors: list[list[float]], scale: float) -> np.ndarray:
    """floor(scale * x) as doubles, which hold these whole numbers exactly; shorter vectors are filled with zeros."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    with np.errstate(over="ignore"):
        return np.clip(np.floor(out * scale), -_HUGE, _HUGE)


def usable(vector: Column, vec_id: Column) -> Column:
    """Whether a row takes part. A NULL component makes the condition NULL or false."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    return vec_id.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _widened(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows to all pivots."""
    width = max(rows.shape[1], pivots.shape[1])
    rows, pivots = _widened(rows, width), _widened(pivots, width)
    with np.errstate(over="ignore", invalid="ignore"):
        return np.stack([np.sqrt(((rows - pivot) ** 2).sum(1)) for pivot in pivots], 1) if len(pivots) else np.zeros((len(rows), 0))


def choose_pivots(sample: np.ndarray, number: int) -> np.ndarray:
    """Farthest first: each pivot is the sample row with the largest distance to those chosen before."""
    if not len(sample):
        return sample
    chosen, nearest = [0], distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(number, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _packed(rows: np.ndarray) -> tuple[str, bytes]:
    """The smallest type that holds the whole numbers."""
    most = np.abs(rows).max(initial=0)
    kind = next((k for k, limit in (("<i1", 127), ("<i2", 32767), ("<i4", 2**31 - 1)) if most <= limit), "<f8")
    return kind, rows.astype(kind).tobytes()


def _block(row, kind_of: str = "vectors") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, "<i8")
    vectors = np.frombuffer(row.vectors, row.kind).reshape(len(ids), -1).astype("float64")
    return ids, vectors, np.frombuffer(row.to_pivots, "<f8").reshape(len(ids), -1)


def blocks(rows: DataFrame, pivots: np.ndarray, scale: float) -> DataFrame:
    """Rows (vec_id, vector, is_query) packed with their pivot distances, no shuffle."""
    target = arrow_schema(rows.sparkSession, _BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            found = []
            ids, vectors = np.array(batch.column(0).to_pylist(), "<i8"), whole(batch.column(1).to_pylist(), scale)
            asks = np.array(batch.column(2).to_pylist(), bool)
            for is_query, own, size in ((False, np.arange(len(ids)), BLOCK), (True, np.flatnonzero(asks), QUERY_BLOCK)):
                for at in range(0, len(own), size):
                    chosen = own[at : at + size]
                    kind, packed = _packed(vectors[chosen])
                    found.append((is_query, part, seq, len(chosen), kind, ids[chosen].tobytes(), packed, distances(vectors[chosen], pivots).astype("<f8").tobytes()))
                    seq += 1
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*found, strict=True), target, strict=True)], schema=target)

    return rows.mapInArrow(run, _BLOCKS)


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole-number inner products, at any size."""
    large = [sum(int(a) * int(b) for a, b in zip(query, row, strict=True)) for row in rows]
    return np.array([min(max(x, -(2**63)), 2**63 - 1) for x in large], "int64")


class Best:
    """The k best (score, id) of a query so far."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.zeros(0, "int64"), np.zeros(0, "int64")

    @property
    def least(self) -> int | None:
        return int(self.scores[-1]) if len(self.scores) >= self.k else None

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.least is not None:
            good = scores >= self.least
            ids, scores = ids[good], scores[good]
        if len(ids):
            ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
            order = np.lexsort((ids, -scores))
            _, first = np.unique(ids[order], return_index=True)  # an id's best score
            order = order[np.sort(first)][: self.k]
            self.ids, self.scores = ids[order], scores[order]


def _around(distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """float32 numbers surely below and above a distance, by far more than its rounding. One that is not finite is between 0 and infinity, so it bounds nothing."""
    with np.errstate(over="ignore", invalid="ignore"):
        low, high = (distance * (1 - 2.0**-20)).astype("float32"), (distance * (1 + 2.0**-20)).astype("float32")
    return np.where(np.isfinite(low), low, np.float32(0)), np.where(np.isnan(high), np.float32(np.inf), high)


def search(query_block, candidate_block, best: list[Best]) -> None:
    """Offer the rows of a block to its queries, in bound order, each until no later row can enter."""
    (q_ids, queries, q_pivots), (ids, rows, pivots) = query_block, candidate_block
    width = max(queries.shape[1], rows.shape[1])
    queries, rows = _widened(queries, width), _widened(rows, width)
    # At least 1 each, as a number must fit by itself, too: infinity times 0 is none.
    with np.errstate(over="ignore"):
        largest = np.abs(queries).max(initial=1) * np.abs(rows).max(initial=1) * max(1, width)
    fits = "float32" if largest < 2**24 else "float64" if largest < 2**53 else None
    if fits is None:
        for i, query in enumerate(queries):
            other = ids != q_ids[i]
            best[i].offer(ids[other], _exact(query, rows[other]))
        return
    exact_rows, exact_queries = rows.astype(fits), queries.astype(fits)
    bound = np.zeros((len(queries), len(rows)), "float32")
    apart = np.empty_like(bound)
    for (my_low, my_high), (their_low, their_high) in zip(map(_around, q_pivots.T), map(_around, pivots.T), strict=True):
        np.subtract(my_low[:, None], their_high[None, :], out=apart)
        np.maximum(bound, apart, out=bound)
        np.subtract(their_low[None, :], my_high[:, None], out=apart)
        np.maximum(bound, apart, out=bound)
    with np.errstate(over="ignore"):
        norms = (queries**2).sum(1)[:, None] + (rows**2).sum(1)[None, :]
    # Rounded bounds get slack, so that they stay above the exact scores.
    upper = (norms - bound.astype("float64") ** 2) / 2 + 1e-4 * norms + 1
    upper[q_ids[:, None] == ids[None, :]] = -np.inf
    for i in range(len(queries)):
        order = np.argsort(-upper[i])
        limits = upper[i][order]
        at, size = 0, 4 * best[i].k
        while at < len(order) and limits[at] > -np.inf and (best[i].least is None or limits[at] >= best[i].least):
            chosen = order[at : at + size]
            chosen = chosen[upper[i][chosen] > -np.inf]
            best[i].offer(ids[chosen], (exact_rows[chosen] @ exact_queries[i]).astype("int64"))
            at, size = at + size, 2 * size


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, pivots: int = 32, pivot_sample: int = 1000, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row where ``is_query`` holds.

    Pivots come from at most ``pivot_sample`` rows, drawn in the order of a hash; all rows are indexed.
    """
    valid = vectors.where(usable(F.col(vector_column), F.col(id_column)))
    rows = valid.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    sample = rows.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivot_sample).toArrow()
    chosen = choose_pivots(whole(sample.column(1).to_pylist(), scale), pivots)
    packed = checkpointed(blocks(rows, chosen, scale), "blocks")
    sizes = {r["is_query"]: r["n"] for r in packed.groupBy("is_query").agg(F.sum("number").alias("n")).collect()}
    stripes, groups = max(1, -(-sizes.get(False, 0) // ROWS_PER_STRIPE)), max(1, -(-sizes.get(True, 0) // QUERIES_PER_GROUP))
    place = F.xxhash64("part", "seq")
    candidates = packed.where(~F.col("is_query")).withColumn("stripe", F.pmod(place, F.lit(stripes)).cast("int")).withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    queries = packed.where("is_query").withColumn("lane", F.pmod(place, F.lit(groups)).cast("int")).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))

    def cell(asking: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        parts = []
        held = [_block(row) for row in offered.itertuples()]
        for row in asking.itertuples():
            block = _block(row)
            best = [Best(k) for _ in block[0]]
            for candidate in held:
                search(block, candidate, best)
            parts.append(pd.DataFrame({"query_id": np.repeat(block[0], [len(b.ids) for b in best]), "vec_id": np.concatenate([b.ids for b in best]), "score": np.concatenate([b.scores for b in best])}))
        return pd.concat(parts) if parts else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})

    hits = queries.groupBy("stripe", "lane").cogroup(candidates.groupBy("stripe", "lane")).applyInPandas(cell, _HITS)
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k_sql(every: int, k: int = 20, scale: float = 64.0) -> str:
    """The same in DuckDB's SQL, for vectors of one length."""
    return f"""
        WITH valid AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM valid q JOIN valid c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
        ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {k}"""
