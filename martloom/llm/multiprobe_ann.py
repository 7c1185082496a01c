"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, where a small Euclidean distance is a large cosine. A table hashes a
vector by several random projections, each cut into cells of one width. A query looks into its own
bucket and into buckets whose cells differ by one step in some projections, in the order of
their estimated success: a step costs the square of the distance to that cell's border. The
order over a query's borders, sorted by distance, is worked out once from their expected values.
The candidates of all tables are merged and ranked by their exact cosine.

Hashing says where rows go: a vector is sent to its bucket of each table, a query to the buckets it
visits, and they meet there and nowhere else. A bucket that has too many of either is cut into cells,
parts of its vectors against parts of its queries. How many buckets have to be visited depends on the
vectors; a bounded sample of queries, answered exactly, says it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import fields, stored


@dataclass(frozen=True)
class Settings:
    tables: int = 4
    width: float = 2.1  # of a cell
    bucket: int = 512  # vectors that a bucket should have on average
    recall: float = 0.97  # of the sample's neighbours that have to be found
    sample: int = 128  # queries that say how many buckets to visit
    probes: int = 4096  # buckets looked into in each table at most
    dims: int = 8  # lengths of vectors that are hashed; rarer ones are one bucket each
    seed: int = 20
    vectors: int = 8192  # in a cell, about
    queries: int = 4096


def probe_order(projections: int, probes: int) -> np.ndarray:
    """The first ``probes`` sets of steps by expected cost, as rows over 2 * projections borders.

    Border j is the j-th nearest of a query; border 2 * projections - 1 - j is the other
    border of the same cell, so a set with both makes no sense. Sets are made in order from
    smaller ones by moving the last border on or adding the next (Lv and others, 2007).
    """
    m = projections
    j = np.arange(1, 2 * m + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
    cost = np.where(j <= m, near, far)
    out = np.zeros((probes, 2 * m), np.int8)
    heap: list[tuple[float, tuple[int, ...]]] = [(float(cost[0]), (0,))] if m else []
    n = 1  # the first row is the query's own bucket
    while heap and n < probes:
        total, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < 2 * m:
            step = float(cost[last + 1])
            heapq.heappush(heap, (total - float(cost[last]) + step, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + step, (*chosen, last + 1)))
        if not any(2 * m - 1 - x in chosen for x in chosen):
            out[n, list(chosen)] = 1
            n += 1
    return out[:n]


def _keys(cells: np.ndarray) -> np.ndarray:
    """One number for the cells of all projections (last axis)."""
    out = np.zeros(cells.shape[:-1], np.uint64)
    for k in range(cells.shape[-1]):
        out = (out ^ cells[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


@dataclass(frozen=True)
class Tables:
    """The hash tables for vectors of one length."""

    dim: int
    projections: int  # 0: one bucket for all
    probes: int
    settings: Settings

    def _projected(self, unit: np.ndarray) -> Iterator[np.ndarray]:
        rng = np.random.default_rng([self.settings.seed, self.dim, self.projections])
        for _ in range(self.settings.tables if self.projections else 1):
            directions = rng.standard_normal((self.dim, self.projections))
            shifts = rng.uniform(0, 1, self.projections)
            yield unit @ directions / self.settings.width + shifts

    def buckets(self, unit: np.ndarray) -> np.ndarray:
        """The bucket of every vector in each table: vectors x tables."""
        found = [_keys(np.floor(x)) for x in self._projected(unit)]
        return np.stack(found, 1)

    def visited(self, unit: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
        """The buckets that every query looks into, in order: queries x tables x probes."""
        m = self.projections
        order = probe_order(m, self.probes) if order is None else order
        found = []
        for place in self._projected(unit):
            cell = np.floor(place)
            below = place - cell
            borders = np.concatenate([below, 1 - below], axis=1)  # a step down, a step up
            nearest = np.argsort(borders, axis=1, kind="stable")
            steps = np.zeros((len(unit), 2 * m, m), np.float32)
            query, rank = np.indices(nearest.shape)
            if m:
                steps[query, rank, nearest % m] = np.where(nearest < m, -1, 1)
            found.append(_keys(cell[:, None, :] + order.astype(np.float32) @ steps))
        return np.stack(found, 1)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector by a power of two, which changes no cosine, so that squares stay finite."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0))
    return np.ldexp(vectors, -exponent)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """In double precision on the vectors as they are, each taken by itself."""
    dot = np.array([query @ v for v in vectors])
    return dot / (np.sqrt(query @ query) * np.sqrt(np.array([v @ v for v in vectors])))


def search_cell(
    askers: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, nearest: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(asker, vector id, cosine) of the best ``nearest`` ids for each query."""
    queries, vectors = _scaled(queries), _scaled(vectors)
    unique = len(np.unique(ids)) == len(ids)
    unit_queries, unit = _unit(queries), _unit(vectors)
    out: list[tuple[list, list, list]] = ([], [], [])
    for at in range(0, len(queries), 128):
        close = unit_queries[at : at + 128] @ unit.T
        for k, row in enumerate(close, at):
            some = np.arange(len(ids))
            # Whatever rounding may put among the best is ranked by the exact cosine.
            if len(some) > nearest:
                best = row if unique else _best_of_id(row, ids)
                least = np.partition(best, -nearest)[-nearest] if len(best) >= nearest else -2
                some = np.flatnonzero(row >= least - 1e-9)
            score = _cosines(queries[k], vectors[some])
            best = np.lexsort((ids[some], -score))
            if not unique:
                best = best[np.sort(np.unique(ids[some][best], return_index=True)[1])]
            best = best[:nearest]
            out[0].extend([askers[k]] * len(best))
            out[1].extend(ids[some[best]].tolist())
            out[2].extend(score[best].tolist())
    return np.array(out[0], np.int64), np.array(out[1], np.int64), np.array(out[2], np.float64)


def _best_of_id(values: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The largest value of each id."""
    order = np.lexsort((values, ids))
    return values[order][np.flatnonzero(np.diff(ids[order], append=ids[order[-1]] + 1))]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


_PLACE = ["dim", "table", "bucket"]
_FOUND = "asker long, vec_id long, score double"


def _met(vectors: pa.Table, queries: pa.Table, nearest: int) -> pa.Table:
    if not vectors.num_rows or not queries.num_rows:
        columns = [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())]
    else:
        columns = [
            pa.array(x)
            for x in search_cell(
                queries["id"].to_numpy(),
                _matrix(queries["vector"]),
                vectors["id"].to_numpy(),
                _matrix(vectors["vector"]),
                nearest,
            )
        ]
    return pa.Table.from_arrays(columns, names=["asker", "vec_id", "score"])


def _routed(
    batches: Iterator[pa.RecordBatch], tables: dict[int, Tables], visits: bool, settings: Settings
) -> Iterator[pa.RecordBatch]:
    """A row for each bucket that a vector is in, or that a query visits."""
    orders: dict[int, np.ndarray] = {}
    for batch in batches:
        column = batch.column(1)
        lengths = column.value_lengths().to_numpy()
        for dim in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == dim)
            own = tables.get(dim) or Tables(dim, 0, 1, settings)
            if visits and dim not in orders:
                orders[dim] = probe_order(own.projections, own.probes)
            for at in range(0, len(rows), 512):
                some = rows[at : at + 512]
                unit = _unit(_scaled(_matrix(column.take(pa.array(some)))))
                if visits:
                    keys = own.visited(unit, orders[dim])
                else:
                    keys = own.buckets(unit)[:, :, None]
                n, n_tables, each = keys.shape
                table = np.tile(np.repeat(np.arange(n_tables), each), n)
                index = pa.array(np.repeat(some, n_tables * each))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(table), dim, np.int32)),
                        pa.array(table.astype(np.int32)),
                        pa.array(keys.ravel().view(np.int64)),
                        batch.column(0).take(index),
                        column.take(index),
                    ],
                    names=["dim", "table", "bucket", "id", "vector"],
                )


def _best(batches: Iterator[pa.RecordBatch], sample: list, nearest: int) -> Iterator[pa.RecordBatch]:
    """Exact neighbours of a few queries among this task's vectors."""
    asked: dict[int, list] = {}
    for asker, vector in sample:
        asked.setdefault(len(vector), []).append((asker, vector))
    for batch in batches:
        lengths = batch.column(1).value_lengths().to_numpy()
        for dim, some in asked.items():
            rows = pa.array(np.flatnonzero(lengths == dim))
            if not len(rows):
                continue
            vectors = batch.column(1).take(rows)
            found = search_cell(
                np.array([a for a, _ in some]),
                np.array([v for _, v in some], np.float64),
                np.arange(len(rows)),
                _matrix(vectors),
                nearest,
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0]), vectors.take(pa.array(found[1])), pa.array(found[2])],
                names=["asker", "vector", "score"],
            )


def _ranked(found: DataFrame, by: str, most: int, *ties: str) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.col("score").desc(), *ties)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _fitted(candidates: DataFrame, askers: DataFrame, nearest: int, settings: Settings) -> dict[int, Tables]:
    """Tables for each of the most frequent lengths: so many projections that a bucket has about its
    size, and so many probes that a sample of queries finds its neighbours.

    The sample is ``settings.sample`` queries of a length, those with the smallest hashes; they are
    compared with every vector. If the neighbours are not found with ``settings.probes`` either, the
    length has one bucket, which compares all.
    """
    sizes = candidates.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"))
    often = sizes.where(F.col("n") > 2 * settings.bucket).orderBy(F.col("n").desc(), "dim")
    dims = {r.dim: r.n for r in often.limit(settings.dims).collect()}
    if not dims:
        return {}
    hashed = Window.partitionBy("dim").orderBy(F.xxhash64("vector"), "id")
    sample = (
        askers.withColumn("dim", F.size("vector"))
        .where(F.col("dim").isin(list(dims)))
        .withColumn("place", F.row_number().over(hashed))
        .where(F.col("place") <= settings.sample)
        .collect()
    )
    queries = {r.id: r.vector for r in sample}
    near = _ranked(
        candidates.select("id", "vector").mapInArrow(
            partial(_best, sample=list(queries.items()), nearest=nearest + 1),
            T.StructType([*fields("asker long"), candidates.schema["vector"], *fields("score double")]),
        ),
        "asker",
        nearest + 1,
    ).collect()
    out = {}
    for dim, n in dims.items():
        pairs = [(queries[r.asker], r.vector) for r in near if len(r.vector) == dim]
        m = max(1, round(math.log(n / settings.bucket) / math.log(3)))
        tables = Tables(dim, m, settings.probes, settings)
        probes = _needed(tables, pairs) if pairs else 1
        out[dim] = Tables(dim, m if probes else 0, probes or 1, settings)
    return out


def _needed(tables: Tables, pairs: list[tuple[list[float], list[float]]]) -> int:
    """After how many probes the wanted share of pairs has met in some table; 0 if never."""
    order = probe_order(tables.projections, tables.probes)
    first = np.full(len(pairs), len(order))
    for at in range(0, len(pairs), 32):
        queries, vectors = (
            _unit(_scaled(np.array(x, np.float64))) for x in zip(*pairs[at : at + 32], strict=True)
        )
        met = tables.visited(queries, order) == tables.buckets(vectors)[:, :, None]
        rank = np.where(met.any(2), met.argmax(2), len(order))
        first[at : at + 32] = rank.min(1)
    wanted = int(np.sort(first)[math.ceil(tables.settings.recall * len(first)) - 1])
    return wanted + 1 if wanted < len(order) else 0


def _split(routed: DataFrame, crowded: DataFrame, own: str, other: str) -> DataFrame:
    """Rows of crowded buckets by part, with a copy for each part of the other kind."""
    one = F.lit(1).cast("long")
    parts = crowded.select(*_PLACE, F.col(own).alias("mine"), F.col(other).alias("theirs"))
    mine, theirs = F.coalesce("mine", one), F.coalesce("theirs", one)
    return routed.join(parts, _PLACE, "left").select(
        *_PLACE,
        F.pmod(F.xxhash64("id", "vector"), mine).alias(own),
        F.explode(F.sequence(F.lit(0).cast("long"), theirs - 1)).alias(other),
        "id",
        "vector",
    )


def _search(
    candidates: DataFrame,
    askers: DataFrame,
    tables: dict[int, Tables],
    nearest: int,
    settings: Settings,
) -> DataFrame:
    """The best candidates for each asker in the buckets it visits."""
    schema = T.StructType([*fields("dim int, table int, bucket long"), *candidates.schema.fields])
    own, asked = (
        rows.mapInArrow(
            partial(_routed, tables=tables, visits=visits, settings=settings), schema
        )
        for rows, visits in ((candidates, False), (askers, True))
    )
    counted = own.select(*_PLACE, F.lit(1).alias("v"), F.lit(0).alias("q")).unionAll(
        asked.select(*_PLACE, F.lit(0), F.lit(1))
    )
    counted = counted.groupBy(*_PLACE).agg(F.sum("v").alias("v"), F.sum("q").alias("q"))
    # Parts of buckets with too many of either; of these there are few, however many rows they have.
    parts = {
        c: F.greatest(F.ceil(F.col(c) / most), F.lit(1)).cast("long")
        for c, most in (("v", settings.vectors), ("q", settings.queries))
    }
    crowded = stored(counted.withColumns(parts).where("v > 1 OR q > 1"), "crowded")
    left = _split(own, crowded, "v", "q").groupBy(*_PLACE, "v", "q")
    right = _split(asked, crowded, "q", "v").groupBy(*_PLACE, "v", "q")

    def met(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        return _met(vectors, queries, nearest)

    found = left.cogroup(right).applyInArrow(met, _FOUND)
    return found.groupBy("asker", "vec_id").agg(F.max("score").alias("score"))


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    nearest: int = 5,
    settings: Settings | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (cosine) of the nearest found for each query row.

    ``is_query`` picks the queries among the rows; every other row is a candidate, ranked by
    largest cosine, then smaller id. Rows whose id is NULL or whose vector is NULL, empty, zero
    or holds NULL or non-finite components take no part, and vectors are only compared with
    those of as many components. Rows that share an id are one neighbour, by their best
    cosine, and one query, answered by the best of its rows. Of equal vectors those with the smallest
    ids stand for all, as many as can be among the nearest, and equal queries are searched for once.
    Queries that find fewer than ``nearest`` are compared with all vectors. No rows give no rows.
    """
    settings = settings or Settings()
    usable = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(
        "id IS NOT NULL AND size(vector) > 0 AND exists(vector, x -> x <> 0) AND forall(vector, "
        "x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    smallest = Window.partitionBy("vector").orderBy("id")
    candidates = stored(
        usable.select("id", "vector")
        .distinct()
        .withColumn("place", F.row_number().over(smallest))
        .where(F.col("place") <= nearest + 1)
        .select("id", "vector"),
        "candidates",
    )
    askers = stored(
        usable.where("asks")
        .select("vector")
        .distinct()
        .select(F.monotonically_increasing_id().alias("id"), "vector"),
        "askers",
    )
    tables = _fitted(candidates, askers, nearest, settings)
    # One more than wanted: a query's own row is among what it finds.
    found = _ranked(
        _search(candidates, askers, tables, nearest + 1, settings), "asker", nearest + 1, "vec_id"
    ).select("asker", "vec_id", "score")
    found = stored(found, "found")
    if tables:
        enough = found.groupBy("asker").agg(F.count("*").alias("n")).where(F.col("n") > nearest)
        few = stored(
            askers.join(enough, F.col("id") == F.col("asker"), "left_anti").select("id", "vector"),
            "few",
        )
        if not few.isEmpty():
            found = found.unionAll(_search(candidates, few, {}, nearest + 1, settings)).distinct()
    queries = (
        usable.where("asks")
        .select(F.col("id").alias("query_id"), "vector")
        .distinct()
        .join(askers.withColumnRenamed("id", "asker"), "vector")
        .select("query_id", "asker")
    )
    best = (
        queries.join(found, "asker")
        .where("query_id <> vec_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    return _ranked(best, "query_id", nearest, "vec_id").select("query_id", "rank", "vec_id", "score")
