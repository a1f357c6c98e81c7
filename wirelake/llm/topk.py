"""Exact top-k inner products: vectors by descending length, rotated partial sums, residual bounds.

Candidates are ranked by length and cut into waves that grow by ``GROWTH``, the longest vectors
first. Queries go out in blocks of bounded size. A wave's tasks search their candidates for a
block with the scores that earlier waves have reached; a query whose length times the longest
candidate ahead stays below its k-th score is finished. Within a task, the partial sums of the
leading directions (the right singular vectors of all candidates) plus the product of what is
left of both lengths (Cauchy-Schwarz) bound a score; pairs below the k-th score so far are passed
over, all others are computed in whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from wirelake.llm import common
from wirelake.llm.shards import numbered

SCALE, TOP, EVERY = 256, 5, 50
#: Candidates of the first wave, and how much more each further wave has.
FIRST_WAVE, GROWTH = 32_768, 8
#: Candidates of one file of a wave.
FILE_ROWS = 16_384
#: Bytes of the query vectors that are broadcast at once.
BLOCK_BYTES = 32 << 20
#: Queries and candidates of one product.
QUERY_ROWS, CANDIDATE_ROWS = 4096, 2048
#: Share of pairs left from which on a whole product is cheaper than single pairs.
DENSE = 0.005
_LEAST = np.iinfo(np.int64).min
_NO_ID = np.iinfo(np.int64).max
_FOUND = "query bigint, query_id bigint, vec_id bigint, score bigint"


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``dims`` numbers; what a list lacks is zero."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    flat, sizes = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], np.diff(ends)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """All inner products of the rows of two whole-number matrices, exact."""
    if bound < 2**52:  # each partial sum is a whole number that a double holds
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def pair_products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """The inner products of row pairs, exact."""
    if bound < 2**62:
        return np.einsum("ij,ij->i", a, b, dtype=np.int64)
    return (a.astype(object) * b.astype(object)).sum(axis=1).astype(np.int64)


def prefixes(dims: int) -> list[tuple[int, int]]:
    """Ranges of leading directions after which the bound is looked at."""
    ends = sorted({max(1, dims // 8), max(1, dims // 4), max(1, dims // 2)})
    return list(zip([0, *ends], ends))


class Rotated:
    """Vectors along the leading directions, and how long the rest of each is after each prefix."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray):
        turned = vectors.astype(np.float32) @ turn.astype(np.float32)
        squares = turned.astype(np.float64) ** 2
        self.length = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.steps = []
        for a, b in prefixes(turn.shape[1]):
            rest = np.sqrt(squares[:, b:].sum(axis=1))
            self.steps.append((np.ascontiguousarray(turned[:, a:b]), rest.astype(np.float32)))


class Best:
    """The k best of each query so far: scores, then ids."""

    def __init__(self, bars: np.ndarray, k: int):
        self.k = k
        self.bars = bars.copy()
        self.scores = np.full((len(bars), k), _LEAST)
        self.ids = np.full((len(bars), k), _NO_ID)
        self.filled = np.zeros(len(bars), np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.bars[query]
        query, score, ids = query[keep], score[keep], ids[keep]
        if not len(query):
            return
        touched = np.unique(query)
        old = np.arange(self.k) < self.filled[touched][:, None]
        query = np.concatenate([query, np.broadcast_to(touched[:, None], old.shape)[old]])
        score = np.concatenate([score, self.scores[touched][old]])
        ids = np.concatenate([ids, self.ids[touched][old]])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        keep = rank < self.k
        query, rank = query[keep], rank[keep]
        self.scores[query, rank], self.ids[query, rank] = score[keep], ids[keep]
        self.filled[touched] = 0
        np.add.at(self.filled, query, 1)
        full = touched[self.filled[touched] == self.k]
        self.bars[full] = np.maximum(self.bars[full], self.scores[full, self.k - 1])


def search_rows(
    best: Best, queries: np.ndarray, places: np.ndarray, turned: Rotated,
    others: np.ndarray, ids: np.ndarray, other_places: np.ndarray, turn: np.ndarray,
) -> None:
    """Look for better scores of all queries among ``others``, which come by descending length."""
    for low in range(0, len(others), CANDIDATE_ROWS):
        part = slice(low, low + CANDIDATE_ROWS)
        x, x_ids, x_places = others[part], ids[part], other_places[part]
        rotated = Rotated(x, turn)
        longest = rotated.length.max()
        # Room for the rounding of single precision; lengths are rounded far less.
        reach = turned.length * longest
        for live in _slices(np.flatnonzero(reach * (1 + 1e-9) + 1 >= best.bars), QUERY_ROWS):
            bound = float(turned.length[live].max()) * float(longest)
            # Rounding of single precision; beyond its range nothing is passed over.
            room = np.float32((4e-7 * turn.shape[0] + 1e-6) * bound + 1) if bound < 1e30 else np.float32(np.inf)
            bars, sums, left = best.bars[live].astype(np.float32)[:, None], None, None
            rows = np.arange(len(live))
            for (q_part, q_rest), (x_part, x_rest) in zip(turned.steps, rotated.steps):
                piece = q_part[live[rows]] @ x_part.T
                sums = piece if sums is None else sums + piece
                left = ~(sums + q_rest[live[rows]][:, None] * x_rest + room < bars[rows])
                some = left.any(axis=1)
                if not some.all():
                    rows, sums, left = rows[some], sums[some], left[some]
                if np.count_nonzero(left) <= DENSE * len(live) * len(x):
                    break
            if not len(rows):
                continue
            q = live[rows]
            if np.count_nonzero(left) > DENSE * len(live) * len(x):
                scores = products(queries[q], x, bound)
                _, mine, own = np.intersect1d(places[q], x_places, assume_unique=True, return_indices=True)
                scores[mine, own] = _LEAST
                least = best.bars[q]
                if len(x) > best.k:
                    least = np.maximum(least, np.partition(scores, len(x) - best.k, axis=1)[:, len(x) - best.k])
                i, j = np.nonzero((scores >= least[:, None]) & (scores > _LEAST))
                best.add(q[i], scores[i, j], x_ids[j])
                continue
            i, j = np.nonzero(left)
            for pairs in _slices(np.arange(len(i)), 1 << 15):
                a, b = q[i[pairs]], j[pairs]
                other = places[a] != x_places[b]
                a, b = a[other], b[other]
                best.add(a, pair_products(queries[a].astype(np.int64), x[b].astype(np.int64), bound), x_ids[b])


def _slices(values: np.ndarray, size: int) -> Iterator[np.ndarray]:
    for low in range(0, len(values), size):
        yield values[low : low + size]


def _search(block: Broadcast, live: Broadcast, turn: Broadcast, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if best is None:
                chosen, bars = live.value
                queries, names, places = (a[chosen] for a in block.value)
                turned, best = Rotated(queries, turn.value), Best(bars, k)
            search_rows(
                best, queries, places, turned, matrix(batch.column(2), turn.value.shape[0]),
                batch.column(1).fill_null(_NO_ID).to_numpy(zero_copy_only=False), batch.column(0).to_numpy(), turn.value,
            )
        if best is not None:
            row, rank = np.nonzero(np.arange(k) < best.filled[:, None])
            ids = best.ids[row, rank]
            columns = [pa.array(places[row]), pa.array(names[row]), pa.array(ids, mask=ids == _NO_ID), pa.array(best.scores[row, rank])]
            for low in range(0, len(row), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(low, 1 << 16) for c in columns], ["query", "query_id", "vec_id", "score"])

    return run


def directions(vectors: DataFrame, dims: int) -> np.ndarray:
    """The right singular vectors of all rows, the strongest first.

    Each task adds up its products of components; those sums are added by place, so the driver
    gets ``dims`` times ``dims`` numbers, however many rows there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            rows = matrix(batch.column(0), dims).astype(np.float64)
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["sums"])

    sums = vectors.select("vector").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("i", "x"))
    total = np.zeros(dims * dims)
    for r in sums.groupBy("i").agg(F.sum("x").alias("x")).toLocalIterator():
        total[r["i"]] = r["x"]
    total = np.nan_to_num(total, posinf=0.0).reshape(dims, dims)
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1].copy()


def prepared(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """Usable rows: vec_id, whole-number vector, its length, and a number of the row."""
    value = F.col(vector)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(value, lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.filter(value.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), whole.alias("vector"), F.monotonically_increasing_id().alias("row")
    )
    squares = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    return rows.withColumn("length", F.sqrt(squares))


def top_products(
    vectors: DataFrame, wanted: Column, k: int = TOP, *, vec_id: str = "vec_id", vector: str = "embedding",
    scale: int = SCALE, first_wave: int = FIRST_WAVE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` rows with the highest inner products of each row that ``wanted`` (on vec_id) chooses.

    query (a number of the query row), query_id, rank from 1, vec_id, score. Components count as
    ``floor(scale * x)``. A row is no candidate of its own, but other rows with its vec_id are;
    ties go to the smaller vec_id, null last. Null vectors and those with null or non-finite
    components take no part; components that a shorter vector lacks are zero, so an empty vector
    scores 0; a null vec_id is never a query. Scores beyond 64 bits end the job. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ready = common.written(prepared(vectors, vec_id, vector, scale), "vectors")
    dims = ready.agg(F.max(F.size("vector"))).first()[0] or 0
    dims = max(dims, 1)
    placed, total = numbered(ready, [F.col("length").desc(), "row"])
    wave = F.expr(f"CASE WHEN place < {first_wave} THEN 0 ELSE 1 + CAST(floor(log({GROWTH}, place / {first_wave})) AS INT) END")
    path = common.run_folder(spark, "waves")
    stored = placed.select("place", "vec_id", "vector", "length", wave.alias("wave"))
    stored.write.partitionBy("wave").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    stored = spark.read.schema(stored.schema).parquet(path)
    waves = sorted((r["wave"], r["n"]) for r in stored.groupBy("wave").agg(F.max("length").alias("n")).collect())

    asked = stored.filter(F.coalesce(wanted, F.lit(False)) & F.col("vec_id").isNotNull()).select(
        "vec_id", "vector", "length", F.col("place").alias("query")
    )
    asked, n_queries = numbered(asked, ["query"])
    asked = common.written(asked, "queries")
    nothing = spark.createDataFrame([], _FOUND)
    if not n_queries:
        return nothing.withColumn("rank", F.lit(1)).select("query", "query_id", "rank", "vec_id", "score")
    turn = spark.sparkContext.broadcast(directions(ready, dims))
    rows_at_once = max(block_bytes // (8 * dims), 1)

    tables = []
    for low in range(0, n_queries, rows_at_once):
        table = asked.filter((F.col("place") >= low) & (F.col("place") < low + rows_at_once)).orderBy("place").toArrow()
        queries, places = matrix(table["vector"], dims), table["query"].to_numpy()
        lengths = table["length"].to_numpy()
        small = np.int16 if np.abs(queries).max(initial=0) < 1 << 15 else np.int64
        block = spark.sparkContext.broadcast((queries.astype(small), table["vec_id"].to_numpy(), places))
        bars = np.full(len(places), _LEAST)
        mine = []
        for number, longest in waves:
            # Lengths are rounded; a query is left out only if it is beyond that rounding.
            chosen = np.flatnonzero(lengths * longest * (1 + 1e-9) + 1 >= bars)
            if not len(chosen):
                break
            live = spark.sparkContext.broadcast((chosen, bars[chosen]))
            found = stored.filter(F.col("wave") == number).select("place", "vec_id", "vector").mapInArrow(
                _search(block, live, turn, k), _FOUND
            )
            mine.append(common.written(found, "found"))
            if number != waves[-1][0]:
                reached = ranked(_all(mine), k).filter(F.col("rank") == k).select("query", "score").toArrow()
                at = np.searchsorted(places, reached["query"].to_numpy())
                bars[at] = np.maximum(bars[at], reached["score"].to_numpy())
        tables += mine
    return ranked(_all(tables), k)


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each query; tasks keep no more than that before they meet."""
    order = W.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    rank = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return rank.select("query", "query_id", "rank", "vec_id", "score")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    return top_products(vectors, F.col("vec_id") % EVERY == 0).select("query_id", "rank", "vec_id", "score")


def op13_sql() -> str:
    return f"""
    WITH usable AS (
      SELECT vec_id, row_number() OVER () AS place,
             list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
    ), scored AS (
      SELECT q.place, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM usable q JOIN usable c ON q.place <> c.place
      WHERE q.vec_id % {EVERY} = 0
    ), best AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM best WHERE rank <= {TOP}"""
