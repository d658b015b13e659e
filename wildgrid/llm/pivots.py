"""Exact top-k search by inner product, with a table of distances to pivots.

Vectors are integers: ``floor(256 * x)`` of each component. Pivots are rows of a bounded
sample, each the farthest from those before it. Every row keeps its distances to all pivots.
For a query q and a row c the distance is at least ``max over pivots |d(q, p) - d(c, p)|``, so
the inner product is at most ``(|q|^2 + |c|^2 - that^2) / 2``. Rows lie in blocks of near ones
with the least and largest distance to each pivot, which bound a whole block at once.

1. Every query block finds the row blocks with the highest bounds; these give each
   query a first list of k scores, whose last is its mark.
2. Row blocks whose bound reaches the mark of a query in the block are sent to it, in order of
   their bounds. Rows are evaluated in order of bounds too, the marks rise meanwhile, and
   what no mark allows any more is left out. A bound is never below a score (it carries the
   rounding's slack), so the result is exact whatever the pivots are.

Blocks meet in equi-joins by block and lane; what is broadcast is the pivots alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, table, written

SCALE = 256
PIVOTS = 64
#: Rows that pivots are chosen from at most, taken by the smallest hashes of their keys; the search covers every row.
SAMPLE = 4096
ROW_BLOCK, QUERY_BLOCK = 2048, 512
#: Row blocks of one lane, whose bounds are looked at together; a lane's blocks meet a query block in one task.
LANE = 256
#: Query blocks meet a lane's bounds in so many groups.
SALTS = 32
#: Row blocks that give a query block its first marks.
FIRST = 2
#: Rows that are evaluated between two looks at the marks.
STEP = 256
LOW = np.iinfo(np.int64).min

# --- vectors ------------------------------------------------------------------


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of rows that take part: v holds floor(scale * x) of each component.

    Left out are null ids, null vectors, those with a null or non-finite component, and those with a component so large
    that scores might not fit 64 bits (beyond 1.4 million at 64 components). Rows of one vec_id are
    one row, that with the smallest vector. Where lengths differ, shorter vectors count as if zeros followed; an empty one is all zeros.
    """
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))")
    rows = rows.withColumn("y", F.transform("x", lambda c: F.floor(c * scale)))
    size = rows.agg(F.max(F.size("y"))).first()[0] or 0
    most = math.isqrt((2**63 - 1) // max(size, 1)) - 1
    v = F.concat(F.transform("y", lambda c: c.cast("int")), F.array_repeat(F.lit(0), F.lit(size) - F.size("y")))
    rows = rows.where(F.forall("x", lambda c: F.abs(c) * scale < min(most, 2**31 - 2))).select("vec_id", v.alias("v"))
    repeated = rows.groupBy("vec_id").count().where("count > 1").select("vec_id")
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.join(repeated, "vec_id", "left_anti").unionByName(one)


def choose(rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray | None:
    """Pivots (number, dimension), each the row of the sample that is farthest from all before; None without rows."""
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    if not some:
        return None
    x = np.array([r[0] for r in some], np.float64).reshape(len(some), -1)
    chosen, near = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < pivots and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(1)) for p in pivots], 1).astype(np.float32)


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v) -> vec_id, v (int32), dist (float32, to each pivot), cell (the nearest pivot)."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)
                d = _distances(x.astype(np.float64), shared.value)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), _packed(x.astype("<i4")), _packed(d), pa.array(d.argmin(1).astype(np.int32))], names=["vec_id", "v", "dist", "cell"])

    return rows.mapInArrow(run, "vec_id long, v binary, dist binary, cell int")


def _packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


# --- blocks -------------------------------------------------------------------

_BLOCK = "block int, ids binary, v binary, dist binary, norm binary, low binary, high binary, longest double"
_NAMES = ["block", "ids", "v", "dist", "norm", "low", "high", "longest"]


def blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows of ``pivot_table`` in blocks of about ``size``, and the number of blocks.

    Small cells share a block; a large one has many, dealt by a hash of the id, so equal vectors spread too.
    """
    first, many, number, held = {}, {}, 0, 0
    for cell, n in sorted(rows.groupBy("cell").count().collect()):  # at most one line a pivot
        if held and held + n > size:
            number, held = number + 1, 0
        first[cell], many[cell] = number, max(1, -(-n // size))
        held = held + n if many[cell] == 1 else size
        number += many[cell] - 1
    count = number + 1
    at = F.create_map(*[F.lit(x) for c in first for x in (c, first[c])]) if first else F.lit(None)
    share = F.create_map(*[F.lit(x) for c in many for x in (c, many[c])]) if first else F.lit(None)
    block = (at[F.col("cell")] + F.pmod(F.xxhash64("vec_id"), share[F.col("cell")])).cast("int") if first else F.lit(0)
    grouped = rows.groupBy(block.alias("block")).agg(F.collect_list(F.struct("vec_id", "v", "dist")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, v, dist = b.column("rows").slice(i, 1).flatten().flatten()
                ids = ids.to_numpy()
                order = np.argsort(ids)
                v = np.frombuffer(b"".join(v.to_pylist()), "<i4").reshape(len(ids), -1)[order]
                d = np.frombuffer(b"".join(dist.to_pylist()), np.float32).reshape(len(ids), -1)[order]
                norm = (v.astype(np.float64) ** 2).sum(1)
                out = [[b.column("block")[i].as_py()], *([x.tobytes()] for x in (ids[order], v, d, norm, d.min(0), d.max(0))), [float(norm.max())]]
                yield pa.RecordBatch.from_arrays([pa.array(x) if k not in (0,) else pa.array(x, pa.int32()) for k, x in enumerate(out)], names=_NAMES)

    return grouped.mapInArrow(run, _BLOCK), count


# --- bounds -------------------------------------------------------------------


def _highest(q_norm: np.ndarray, norm: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """The largest inner product of vectors with these squared norms that are at least ``apart`` from each other, with slack for rounding."""
    both = q_norm[:, None] + norm[None]
    apart = np.maximum(0, apart - 1e-6 * np.sqrt(both))
    return (both - apart**2) / 2 + 1e-9 * both + 1


def row_bounds(q_dist: np.ndarray, q_norm: np.ndarray, dist: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """(queries, rows): no score of these is higher."""
    apart = np.zeros((len(q_dist), len(dist)), np.float32)
    gap = np.empty_like(apart)
    for p in range(dist.shape[1]):
        np.subtract(q_dist[:, p, None], dist[None, :, p], out=gap)
        np.maximum(apart, np.abs(gap, out=gap), out=apart)
    return _highest(q_norm, norm, apart)


def block_bounds(q_dist: np.ndarray, q_norm: np.ndarray, low: np.ndarray, high: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """(queries, blocks): no score of a query with a row of the block is higher."""
    apart = np.zeros((len(q_dist), len(low)), np.float32)
    for p in range(low.shape[1]):
        np.maximum(apart, np.maximum(low[None, :, p] - q_dist[:, p, None], q_dist[:, p, None] - high[None, :, p]), out=apart)
    # a shorter row of the block may lie nearer; the bound grows with the norm at a fixed distance
    return _highest(q_norm, longest, apart)


def scores(q: np.ndarray, q_norm: np.ndarray, v: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point where that is exact."""
    if len(q) and len(v) and float(q_norm.max()) * float(norm.max()) < 2.0**104:
        return np.rint(q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q.astype(np.int64) @ v.astype(np.int64).T


class Best:
    """The k best rows of each query so far: higher scores first, of equal ones smaller ids."""

    def __init__(self, query_ids: np.ndarray, k: int, ids: np.ndarray | None = None, score: np.ndarray | None = None):
        self.query_ids, self.k = query_ids, k
        self.ids = np.full((len(query_ids), k), -1, np.int64) if ids is None else ids.copy()
        self.score = np.full((len(query_ids), k), LOW) if score is None else score.copy()
        self.held = self.score > LOW

    @property
    def mark(self) -> np.ndarray:
        """What a score must reach; LOW as long as there are fewer than k."""
        return self.score[:, -1]

    def add(self, open_: np.ndarray, ids: np.ndarray, found: np.ndarray) -> None:
        """``found``: scores of the queries at ``open_`` with the rows ``ids``."""
        q, c = np.nonzero((found >= self.mark[open_, None]) & (ids[None] != self.query_ids[open_, None]))
        if not len(q):
            return
        touched, local = np.unique(q, return_inverse=True)
        rows = open_[touched]
        old_q, old_c = np.nonzero(self.held[rows])
        group = np.concatenate([old_q, local])
        all_ids = np.concatenate([self.ids[rows][old_q, old_c], ids[c]])
        all_scores = np.concatenate([self.score[rows][old_q, old_c], found[q, c]])
        order = np.lexsort((all_ids, -all_scores, group))
        group, all_ids, all_scores = group[order], all_ids[order], all_scores[order]
        place = np.arange(len(group)) - np.searchsorted(group, np.arange(len(rows)))[group]
        keep = place < self.k
        for held, new, none in ((self.ids, all_ids, -1), (self.score, all_scores, LOW)):
            part = np.full((len(rows), self.k), none, np.int64)
            part[group[keep], place[keep]] = new[keep]
            held[rows] = part
        self.held[rows] = np.arange(self.k)[None] < np.minimum(np.bincount(group, minlength=len(rows)), self.k)[:, None]


def evaluate(best: Best, q: np.ndarray, q_dist: np.ndarray, q_norm: np.ndarray, ids: np.ndarray, v: np.ndarray, dist: np.ndarray, norm: np.ndarray, step: int = STEP) -> int:
    """Adds a block's rows to ``best`` in order of their bounds until none can enter; returns the scores that were computed."""
    bounds = row_bounds(q_dist, q_norm, dist, norm)
    least = np.where(best.mark == LOW, -np.inf, best.mark.astype(np.float64))
    # a row's place: how far its bound lies above the mark of the query that it suits best
    above = (bounds - np.where(np.isfinite(least), least, bounds.min(1) if bounds.size else 0)[:, None]).max(0)
    order = np.argsort(-above, kind="stable")
    bounds, ids, v, norm, dist = bounds[:, order], ids[order], v[order], norm[order], dist[order]
    rest = np.maximum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1]  # the highest bound from here on
    done = 0
    for lo in range(0, len(ids), step):
        open_ = np.flatnonzero((best.mark == LOW) | (rest[:, lo] >= best.mark))
        if not len(open_):
            break
        part = slice(lo, lo + step)
        best.add(open_, ids[part], scores(q[open_], q_norm[open_], v[part], norm[part]))
        done += len(open_) * len(ids[part])
    return done


# --- search -------------------------------------------------------------------


class _Queries:
    """One query block from its row."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["q_ids"], np.int64)
        self.v, self.dist = (np.frombuffer(row[c], t).reshape(len(self.ids), -1) for c, t in (("q_v", "<i4"), ("q_dist", np.float32)))
        self.norm = np.frombuffer(row["q_norm"])


def _near_blocks(queries: DataFrame, bounds: DataFrame, lanes: int, first: bool) -> DataFrame:
    """(query_block, row_block, lane, bound) of row blocks that may hold what a query of the block wants.

    ``first``: the blocks with the highest bounds of each lane; else all whose bound reaches the mark of a query in the block.
    """
    salt = F.pmod(F.xxhash64("query_block"), F.lit(SALTS)).alias("salt")
    asked = queries.select("*", salt, F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    told = bounds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                q = _Queries(row)
                low, high = (np.frombuffer(b"".join(x[c] for x in row["blocks"]), np.float32).reshape(len(row["blocks"]), -1) for c in ("low", "high"))
                bound = block_bounds(q.dist, q.norm, low, high, np.array([x["longest"] for x in row["blocks"]]))
                number = np.array([x["block"] for x in row["blocks"]], np.int32)
                most = bound.max(0)
                if first:
                    keep = np.argsort(-most, kind="stable")[:FIRST]
                else:
                    mark = np.frombuffer(row["best_score"], np.int64).reshape(len(q.ids), -1)[:, -1]
                    keep = np.flatnonzero(((mark == LOW)[:, None] | (bound >= mark[:, None])).any(0))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keep), row["query_block"], np.int32)), pa.array(number[keep]), pa.array(np.full(len(keep), row["lane"], np.int32)), pa.array(most[keep])], names=["query_block", "row_block", "lane", "bound"])

    slim = asked.join(told, ["lane", "salt"]).drop("salt")
    return slim.mapInArrow(run, "query_block int, row_block int, lane int, bound double")


def _evaluated(pairs: DataFrame, queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Each query block of each lane with its best rows: (query_block, best_ids, best_score), in order of bounds within the lane."""
    own = rows.select(F.col("block").alias("row_block"), "ids", "v", "dist", "norm")
    asked = pairs.select("query_block", "lane").distinct().join(queries, "query_block")
    met = pairs.join(own, "row_block").join(asked, ["query_block", "lane"]).repartition("query_block", "lane").sortWithinPartitions("query_block", "lane", F.col("bound").desc(), "row_block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = q = best = None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([q.ids.tobytes()]), pa.array([best.ids.tobytes()]), pa.array([best.score.tobytes()])], names=["query_block", "q_ids", "best_ids", "best_score"])

        for b in batches:
            for i in range(b.num_rows):
                now = b.column("query_block")[i].as_py(), b.column("lane")[i].as_py()
                if now != at:
                    if at is not None:
                        yield closed()
                    row = {c: b.column(c)[i].as_py() for c in ("q_ids", "q_v", "q_dist", "q_norm", "best_ids", "best_score")}
                    at, q = now, _Queries(row)
                    before = [None if row[c] is None else np.frombuffer(row[c], np.int64).reshape(len(q.ids), k) for c in ("best_ids", "best_score")]
                    best = Best(q.ids, k, *before)
                bound = b.column("bound")[i].as_py()
                if (best.mark > LOW).all() and bound < best.mark.min():
                    continue  # no later block of the lane reaches a mark either
                ids = np.frombuffer(b.column("ids")[i].as_py(), np.int64)
                v, dist = (np.frombuffer(b.column(c)[i].as_py(), t).reshape(len(ids), -1) for c, t in (("v", "<i4"), ("dist", np.float32)))
                evaluate(best, q.v, q.dist, q.norm, ids, v, dist, np.frombuffer(b.column("norm")[i].as_py()))
        if at is not None:
            yield closed()

    return met.drop("row_block").mapInArrow(run, "query_block int, q_ids binary, best_ids binary, best_score binary")


def _lines(best: DataFrame) -> DataFrame:
    """(query_id, vec_id, score), one line for each row that was found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                query, ids, score = (np.frombuffer(r[c], np.int64) for c in ("q_ids", "best_ids", "best_score"))
                some = score > LOW
                yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (np.repeat(query, len(ids) // max(1, len(query))), ids, score)], names=["query_id", "vec_id", "score"])

    return best.select("q_ids", "best_ids", "best_score").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS, row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products with all rows but its own.

    ``rows``, ``queries``: (vec_id, v) of ``whole_numbers``, queries being some of the rows. Equal scores go to the smaller vec_id;
    with fewer rows than k all are returned; without queries or rows nothing is. The result is a table of the
    shared folder; those that it was made from are deleted.
    """
    spark = rows.sparkSession
    chosen = choose(rows, pivots)
    if chosen is None or queries.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    held = written(pivot_table(rows, chosen), "pivots")
    by_row, count = blocks(held, row_block)
    # of the queries' rows the table has the distances already
    by_query, _ = blocks(held.join(queries.select("vec_id"), "vec_id", "left_semi"), query_block)
    lanes = -(-count // LANE)
    by_row = written(by_row.withColumn("lane", F.col("block") % lanes), "row-blocks")
    asked = written(by_query.select(F.col("block").alias("query_block"), *[F.col(c).alias(f"q_{c}") for c in ("ids", "v", "dist", "norm")]), "query-blocks")
    forget(held)
    bounds = by_row.groupBy("lane").agg(F.sort_array(F.collect_list(F.struct("block", "low", "high", "longest"))).alias("blocks"))  # about LANE blocks
    fresh = asked.withColumns({"best_ids": F.lit(None).cast("binary"), "best_score": F.lit(None).cast("binary")})
    place = Window.partitionBy("query_block").orderBy(F.col("bound").desc(), "row_block")
    start = _near_blocks(asked, bounds, lanes, True).withColumn("place", F.row_number().over(place)).where(F.col("place") <= FIRST).withColumn("lane", F.lit(0)).drop("place")
    seeded = written(_evaluated(start, fresh, by_row, k), "marks")
    marked = asked.join(seeded.select("query_block", "best_ids", "best_score"), "query_block")
    rest = _near_blocks(marked, bounds, lanes, False).join(start.select("query_block", "row_block"), ["query_block", "row_block"], "left_anti")
    found = _lines(seeded).unionByName(_lines(_evaluated(rest, marked, by_row, k))).distinct()  # each lane begins with the first marks' rows
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    out = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "top-k")
    forget(by_row, asked, seeded)
    return out


def op13_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole_numbers(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where(F.col("vec_id") % 50 == 0))


OP13_SQL = """
WITH own AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
found AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM own q JOIN own c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM found)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
