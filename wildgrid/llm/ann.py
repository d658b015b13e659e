"""Nearest neighbours by additive quantisation.

Codebooks hold vectors of full dimension; a vector is stored as one code from each,
and stands for the sum of those. Codebooks are fitted to residuals on a bounded
sample (``SAMPLE`` rows) and refined by beam-search encoding and least squares; every row is
encoded by beam search and keeps the norm of its reconstruction and its distance from it.

A search scans all rows once, block by block. The words of a block's rows are summed once, and one product of
matrices has the inner products of these sums with all queries of the task: what tables of query and code words
give by a look-up for each book and pair. The best ``RERANK`` rows of the first block are scored exactly, and the k-th of these scores is
what any other row must reach. Each row's score is bounded by its codes' sum and its distance from it; rows that
the bound doesn't rule out are scored exactly, and what k rows reach then is the new bar. So
the result is that of all rows whatever the vectors are; codes that fit badly cost time, no neighbours. Where codes leave more
than ``DENSE`` of a tile open, a product with the vectors themselves comes between bound and scores.

The scan is linear in rows for each query, and so quadratic. Queries are dealt into blocks and rows into lanes by hashes of
their keys; a task has one block and one lane, holds the block's queries and their best k, and reads the lane's rows in
batches. Rows are sent once for each block of queries and queries once for each lane; k rows a query and lane come out.

``shortlist`` is the search by codes alone, by tables, where an index is all there is.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

BOOKS, WORDS = 32, 128
BEAM = 4
#: Rows that codebooks are fitted to at most, taken by the smallest hashes of their keys.
SAMPLE = 8192
RERANK = 256
QUERY_BLOCK, ROW_BLOCK = 512, 8192
#: A shortlist's row groups are dealt into so many lanes; a lane's groups are scanned one after the other, and give one shortlist a query.
LANES = 4
#: The search deals rows into so many lanes at most, and queries into blocks that a task holds whole, of so many bytes of vectors at most.
#: Blocks are more and smaller, down to QUERY_BLOCK queries, where there would be fewer than two tasks a core.
SEARCH_LANES, QUERY_BYTES = 12, 64_000_000
#: Bytes of vectors that a batch of rows has at most.
BLOCK_BYTES = 4_000_000
#: Pairs that are held at a time.
TILE = 1 << 21
#: Share of open pairs beyond which a product of whole blocks is cheaper than single rows.
DENSE = 0.05
METRICS = ("ip", "l2")
_NONE = np.iinfo(np.int64).max


# --- codebooks ----------------------------------------------------------------


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = ((centres**2).sum(1) - 2 * (x @ centres.T)).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (rows, books) by beam search: each book extends the best ``beam`` sums so far."""
    # less the books' means and by a common scale, so that single precision has all digits for what differs
    mean = books.mean(1)
    x, books = x - mean.sum(0), books - mean[:, None]
    scale = max(np.abs(books).max(), np.abs(x).max(initial=0)) or 1.0
    x, books = x / scale, (books / scale).astype(np.float32)
    m, k, d = books.shape
    own, twice = (books**2).sum(2), np.ascontiguousarray(-2 * books.transpose(0, 2, 1))
    out = np.empty((len(x), m), np.uint8)
    for lo in range(0, len(x), 512):
        rest = x[lo : lo + 512].astype(np.float32)[:, None]  # what each of the sums so far leaves
        n = len(rest)
        codes, loss, line = np.zeros((n, 1, 0), np.uint8), np.zeros((n, 1), np.float32), np.arange(n)
        for b in range(m):
            new = (rest.reshape(-1, d) @ twice[b]).reshape(n, -1, k)
            new += own[b]
            new += loss[:, :, None]
            flat = new.reshape(n, -1)
            best = np.empty((n, min(beam, flat.shape[1])), np.int64)
            loss = np.empty(best.shape, np.float32)
            for i in range(best.shape[1]):
                best[:, i] = flat.argmin(1)
                loss[:, i] = flat[line, best[:, i]]
                flat[line, best[:, i]] = np.inf
            came, word = best // k, best % k
            codes = np.concatenate([codes[line[:, None], came], word[:, :, None].astype(np.uint8)], 2)
            rest = rest[line[:, None], came] - books[b][word]
        out[lo : lo + n] = codes[line, loss.argmin(1)]
    return out


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return sum(books[m][codes[:, m]] for m in range(len(books)))


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = 5, rounds: int = 1) -> np.ndarray:
    """Codebooks (books, words, dimension): residual k-means, then rounds of beam encoding and a joint least-squares fit."""
    mean = x.mean(0, dtype=np.float64)
    x = x - mean
    rng, rest, found = np.random.default_rng(seed), x, []
    for _ in range(books):
        c = _kmeans(rest, words, rng)
        rest = rest - c[((c**2).sum(1) - 2 * (rest @ c.T)).argmin(1)]
        found.append(c)
    out = np.stack(found)
    for _ in range(rounds):
        codes = encode(x, out).astype(np.int64) + np.arange(books) * words
        size = books * words
        gram, right = np.zeros((size, size)), np.zeros((size, x.shape[1]))
        for a in range(books):
            np.add.at(right, codes[:, a], x)
            for b in range(books):
                np.add.at(gram, (codes[:, a], codes[:, b]), 1)
        gram[np.diag_indices(size)] += 1e-2
        out = np.linalg.solve(gram, right + 1e-2 * out.reshape(size, -1)).reshape(out.shape)
    out[0] += mean
    return out


def train(vectors: DataFrame, sample: int = SAMPLE, **options) -> np.ndarray | None:
    """Codebooks from the rows with the smallest hashes of vec_id; None without rows."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").collect()
    return fit(np.array([r[0] for r in rows], np.float64), **options) if rows else None


# --- index and search ---------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows that take part: no null, no null or non-finite component, not zero, not empty.

    Of several dimensions only the commonest takes part, of equally common ones the larger.
    Rows of one vec_id are one row, that with the smallest vector in the order of its components.
    """
    v = F.col("embedding")
    if vectors.schema["embedding"].dataType.simpleString() != "array<float>":  # these stay as they are: half the bytes, the same numbers
        v = v.cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")).where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).where(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("embedding", lambda c: c != 0))
    common = rows.groupBy(F.size("embedding").alias("d")).count().agg(F.max(F.struct("count", "d"))["d"]).first()[0]
    if common is not None:
        rows = rows.where(F.size("embedding") == common)
    repeated = rows.groupBy("vec_id").count().where("count > 1").select("vec_id")
    if repeated.limit(1).count() == 0:
        return rows
    one = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return rows.join(repeated, "vec_id", "left_anti").unionByName(one)


def build_index(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, embedding) -> vec_id, codes, norm (squared, of the reconstruction), error (distance from it): every row."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("embedding"), shared.value.shape[2])
            codes = encode(x, shared.value)
            own = decode(codes, shared.value)
            norm, error = (own**2).sum(1), np.sqrt(((x - own) ** 2).sum(1))
            yield pa.RecordBatch.from_pydict({"vec_id": b.column("vec_id"), "codes": pa.array([c.tobytes() for c in codes], pa.binary()), "norm": pa.array(norm), "error": pa.array(error)})

    return vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, codes binary, norm double, error double")


def _matrix(column, dimension: int) -> np.ndarray:
    if len(flat := column.flatten()) != len(column) * dimension:
        raise ValueError(f"vectors of dimension {dimension} are expected")
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64, copy=False)


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k largest; of equal ones the first columns. Ragged rows can't occur: k <= columns."""
    if k >= scores.shape[1]:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    least = np.partition(scores, -k, axis=1)[:, -k][:, None]
    above, equal = scores > least, scores == least
    wanted = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(1)[:, None]))
    return np.nonzero(wanted)[1].reshape(len(scores), k)


def _table_sums(q: np.ndarray, codes: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, base, slack): inner products of queries and reconstructions are sums + base, within slack. Base is each query's own, so sums keep the order of rows."""
    lookup = np.einsum("qd,mkd->mqk", q, books, optimize=True)
    mean = lookup.mean(2, keepdims=True)
    lookup = (lookup - mean).astype(np.float32)
    sums = np.zeros((len(q), len(codes)), np.float32)
    for m in range(len(books)):
        sums += lookup[m][:, codes[:, m]]
    reach = np.sqrt((books**2).sum(2)).max(1).sum()
    slack = 2.0**-22 * len(books) * np.abs(lookup).max(2).sum(0, dtype=np.float64) + 1e-12 * np.sqrt((q**2).sum(1)) * reach
    return sums, mean.sum(0)[:, 0], slack


def scan_block(ids: np.ndarray, codes: np.ndarray, norm: np.ndarray, query_ids: np.ndarray, q: np.ndarray, books: np.ndarray, keep: int, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(vec_id, table score) of the best ``keep`` rows of one block, one line for each query; -inf where there are fewer. Rows must be in ascending order of id."""
    found = []
    for lo in range(0, len(q), 128):
        part, own = q[lo : lo + 128], query_ids[lo : lo + 128, None]
        near, _, _ = _table_sums(part, codes, books)
        if metric == "l2":
            near = 2 * near - norm.astype(np.float32)
        near[ids[None] == own] = -np.inf  # never the query itself
        best = _top(near, min(keep, len(ids)))
        found.append((ids[best], np.take_along_axis(near, best, 1)))
    return tuple(np.concatenate(x) for x in zip(*found))


def merged(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``keep`` of two shortlists for each query, of equal scores the smaller ids."""
    ids, score = (np.concatenate(z, axis=1) for z in zip(x, y))
    order = np.lexsort((ids, -score), axis=1)[:, :keep]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)


def _pairs(rows: DataFrame, queries: DataFrame, fields: tuple[str, ...], asked: tuple[str, ...], groups: int, blocks: int, lanes: int) -> DataFrame:
    """(query_block, lane, rows, asked): every group of rows beside every block of queries."""
    key = F.xxhash64("vec_id")
    rows = rows.groupBy(F.pmod(key, F.lit(groups)).alias("row_group")).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("rows"))
    rows = rows.select((F.col("row_group") % lanes).cast("int").alias("lane"), "rows")
    held = queries.groupBy(F.pmod(key, F.lit(blocks)).alias("query_block")).agg(F.collect_list(F.struct(*asked)).alias("asked"))
    held = held.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    rows = rows.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    return rows.join(held, ["query_block", "lane"]).select("query_block", "lane", "rows", "asked")


def _codes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def shortlist(index: DataFrame, queries: DataFrame, books: np.ndarray, keep: int, metric: str) -> DataFrame:
    """(query_id, vec_id): the ``keep`` rows of the whole index with the best table scores for each query, ties to smaller ids."""
    groups, blocks = max(LANES, -(-index.count() // ROW_BLOCK)), max(1, -(-queries.count() // QUERY_BLOCK))
    pairs = _pairs(index, queries, ("vec_id", "codes", "norm"), ("vec_id", "embedding"), groups, blocks, LANES).sortWithinPartitions("query_block", "lane")
    shared = index.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked_ids, best = None, None, None

        def closed() -> pa.RecordBatch:
            some = best[1] > -np.inf
            query = np.broadcast_to(asked_ids[:, None], some.shape)[some]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (query, best[0][some], best[1][some])], names=["query_id", "vec_id", "near"])

        for b in batches:
            for i in range(b.num_rows):
                now = b.column("query_block")[i].as_py(), b.column("lane")[i].as_py()
                if now != at and at is not None:
                    yield closed()
                r, a = b.column("rows").slice(i, 1).flatten(), b.column("asked").slice(i, 1).flatten()
                ids, codes, norm = r.flatten()
                query_ids, q = a.flatten()
                query_ids = query_ids.to_numpy()
                found = scan_block(ids.to_numpy(), _codes(codes), norm.to_numpy(), query_ids, _matrix(q, shared.value.shape[2]), shared.value, keep, metric)
                best = merged(best, found, keep) if now == at else found
                at, asked_ids = now, query_ids
        if at is not None:
            yield closed()

    found = pairs.mapInArrow(run, "query_id long, vec_id long, near float")
    order = Window.partitionBy("query_id").orderBy(F.col("near").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).select("query_id", "vec_id")


def scores(x: np.ndarray, q: np.ndarray, metric: str) -> np.ndarray:
    return (x * q).sum(1) if metric == "ip" else -((x - q) ** 2).sum(1)


class Nearest:
    """The ``k`` nearest of each query among rows that come block by block, by codes and by the vectors that these leave open.

    A row's score is at most that of its words' sum and what its distance from that sum may add: one product of two
    matrices of single precision, whose rounding is allowed for, against a least number of each query.
    """

    def __init__(self, query_ids: np.ndarray, q: np.ndarray, books: np.ndarray, k: int, rerank: int, metric: str) -> None:
        self.query_ids, self.q, self.k, self.rerank, self.metric = query_ids, q, k, rerank, metric
        self.centre = books.mean(1).sum(0)
        self.words, self.reach = books - books.mean(1)[:, None], np.sqrt((books**2).sum(2)).max(1).sum()
        self.length = np.sqrt((q**2).sum(1))
        self.ids, self.score = np.full((len(q), k), _NONE), np.full((len(q), k), -np.inf)
        self.bar = np.full(len(q), -np.inf)

    def _right(self, own: np.ndarray, error: np.ndarray, scale: float) -> np.ndarray:
        """Rows as sums of words less the centre and distances from them, over a common scale."""
        parts = [own / scale, (error / scale)[:, None]]
        if self.metric == "l2":
            parts.append(((error**2 - (own**2).sum(1)) / scale**2)[:, None])
        return np.concatenate(parts, 1).astype(np.float32)

    def _left(self, at: slice, bar: np.ndarray, scale: float, longest: float) -> tuple[np.ndarray, np.ndarray]:
        """(left, least): where left @ right is below least, the row's score is below ``bar``."""
        q, length = self.q[at], self.length[at]
        if self.metric == "ip":
            size, wide = np.where(length > 0, length, 1), self.reach + longest
            left = np.concatenate([q / size[:, None], np.ones((len(q), 1))], 1)
            least = (bar - q @ self.centre) / size / scale
        else:
            q, radius = q - self.centre, np.sqrt(np.maximum(0, -bar))
            apart = np.sqrt((q**2).sum(1))
            size, wide = 2 * apart + 2 * radius + scale, self.reach + longest + length
            left = np.concatenate([2 * q, 2 * radius[:, None], np.full((len(q), 1), scale)], 1) / size[:, None]
            least = (apart - radius) * (apart + radius) / size / scale
        least = least - 2.0**-22 * (q.shape[1] + 8) - 1e-12 * wide / scale
        odd = ~(np.isfinite(left).all(1) & np.isfinite(least) & np.isfinite(length))
        left[odd], least[odd] = 0, -np.inf
        return left.astype(np.float32), np.nextafter(least.astype(np.float32), np.float32(-np.inf))

    def meet(self, ids: np.ndarray, codes: np.ndarray, error: np.ndarray, x: np.ndarray) -> None:
        """Takes a block of rows, none of them met before."""
        with np.errstate(all="ignore"):
            own, longest = decode(codes, self.words), np.sqrt((x**2).sum(1).max())
            scale = max(np.sqrt((own**2).sum(1).max()), error.max()) or 1.0
            right = self._right(own, error, scale)
            plain = self._right(own, np.zeros(len(ids)), scale) if len(ids) > self.rerank + 1 and np.isneginf(self.bar).any() else None
            whole, step = None, max(1, TILE // len(ids))
            for lo in range(0, len(self.q), step):
                at = slice(lo, min(lo + step, len(self.q)))
                if plain is not None and np.isneginf(self.bar[at]).any():
                    self._first(at, ids, x, plain, scale, longest)
                open_ = self._reaches(at, right, scale, longest)
                if np.count_nonzero(open_) > DENSE * open_.size:
                    if whole is None:
                        centred = x - self.centre
                        size = np.sqrt((centred**2).sum(1).max()) or 1.0
                        whole = self._right(centred, np.zeros(len(ids)), size), size
                    open_ &= self._reaches(at, *whole, longest)
                    if np.count_nonzero(open_) > DENSE * open_.size:
                        open_ &= self._reaches_double(at, x, longest)
                self._check(at, ids, x, open_)

    def _first(self, at: slice, ids: np.ndarray, x: np.ndarray, plain: np.ndarray, scale: float, longest: float) -> None:
        """A first bar: the k-th score of the ``rerank`` rows of the block with the best sums of words."""
        left, _ = self._left(at, np.zeros(at.stop - at.start), scale, longest)
        near = left @ plain.T
        best = np.argpartition(near, len(ids) - self.rerank - 1, axis=1)[:, len(ids) - self.rerank - 1 :]
        score = self._scores(at.start + np.repeat(np.arange(len(best)), best.shape[1]), best.ravel(), x).reshape(best.shape)
        score[(ids[best] == self.query_ids[at, None]) | np.isnan(score)] = -np.inf
        self.bar[at] = np.maximum(self.bar[at], np.partition(score, -self.k, axis=1)[:, -self.k])

    def _reaches(self, at: slice, right: np.ndarray, scale: float, longest: float) -> np.ndarray:
        """Pairs of queries and rows whose bound doesn't rule out the bar."""
        left, least = self._left(at, self.bar[at], scale, longest)
        return ~(left @ right.T < least[:, None])  # a bound that is no number rules nothing out

    def _reaches_double(self, at: slice, x: np.ndarray, longest: float) -> np.ndarray:
        """The same by the vectors' product in double precision, where single precision leaves much open."""
        if self.metric == "ip":
            return ~(self.q[at] @ x.T < (self.bar[at] - 1e-12 * self.length[at] * longest)[:, None])
        q, x = self.q[at] - self.centre, x - self.centre
        a, b = (q**2).sum(1), (x**2).sum(1)
        slack = 1e-12 * (np.sqrt(a) + np.sqrt(b.max())) * (self.length[at] + self.reach + longest)
        return ~(2 * (q @ x.T) - b < (self.bar[at] + a - slack)[:, None])

    def _scores(self, which: np.ndarray, rows: np.ndarray, x: np.ndarray) -> np.ndarray:
        out, step = np.empty(len(rows)), max(1, TILE // 32 // x.shape[1])
        for lo in range(0, len(rows), step):
            out[lo : lo + step] = scores(x[rows[lo : lo + step]], self.q[which[lo : lo + step]], self.metric)
        return out

    def _check(self, at: slice, ids: np.ndarray, x: np.ndarray, open_: np.ndarray) -> None:
        """Scores the open pairs exactly and keeps each query's best k."""
        which, rows = np.divmod(np.flatnonzero(open_), len(ids))
        which += at.start
        other = ids[rows] != self.query_ids[which]  # never the query itself
        which, rows = which[other], rows[other]
        score, found = self._scores(which, rows, x), ids[rows]
        last, last_id = self.score[which, -1], self.ids[which, -1]
        better = ~(score < self.bar[which]) & (~(score <= last) | (score == last) & (found < last_id))
        which, found, score = which[better], found[better], score[better]
        if not len(which):
            return
        some, line = np.unique(which, return_inverse=True)
        line = np.concatenate([np.repeat(np.arange(len(some)), self.k), line])
        found, score = np.concatenate([self.ids[some].ravel(), found]), np.concatenate([self.score[some].ravel(), score])
        order = np.lexsort((found, np.where(np.isnan(score), np.inf, -score), line))
        line = line[order]
        kept = order[np.arange(len(line)) - np.searchsorted(line, line) < self.k]
        self.ids[some], self.score[some] = found[kept].reshape(-1, self.k), score[kept].reshape(-1, self.k)
        self.bar[some] = np.fmax(self.bar[some], self.score[some, -1])

    def batch(self) -> pa.RecordBatch:
        real = (self.ids < _NONE) | (self.score > -np.inf)
        query = np.broadcast_to(self.query_ids[:, None], real.shape)[real]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (query, self.ids[real], self.score[real])], names=["query_id", "vec_id", "score"])


def dealt(rows: DataFrame, queries: DataFrame, blocks: int, lanes: int) -> DataFrame:
    """(task, vec_id, codes, error, embedding): each task has a block of queries, without codes, before a lane of rows."""
    key = F.xxhash64("vec_id")
    asked = queries.select("vec_id", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"), "embedding", F.pmod(key, F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)).cast("array<long>")).alias("lane"))
    rows = rows.select("vec_id", "codes", "error", "embedding", F.pmod(key, F.lit(lanes)).alias("lane"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block"))
    both = asked.unionByName(rows).withColumn("task", (F.col("block") * lanes + F.col("lane")).cast("int")).drop("block", "lane")
    return both.repartitionById(blocks * lanes, "task").sortWithinPartitions("task", F.col("codes").isNotNull())


def checked(index: DataFrame, vectors: DataFrame, queries: DataFrame, books: np.ndarray, k: int, rerank: int, metric: str) -> DataFrame:
    """(query_id, vec_id, score): each lane's k nearest of every query."""
    n, asked, width = index.count(), queries.count(), books.shape[2] * 8
    lanes = max(1, min(SEARCH_LANES, n // ROW_BLOCK))
    wanted = -(-2 * index.sparkSession.sparkContext.defaultParallelism // lanes)
    blocks = max(1, -(-asked // max(1, QUERY_BYTES // width)), min(wanted, asked // QUERY_BLOCK))
    shared = index.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, near = None, [], None
        for b in batches:
            task, row = b.column("task").to_numpy(), b.column("codes").is_valid().to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((np.diff(task) != 0) | (np.diff(row) != 0)) + 1).tolist(), b.num_rows]
            for lo, hi in itertools.pairwise(cuts):
                if lo == hi:
                    continue
                if task[lo] != at:
                    if near is not None:
                        yield near.batch()
                    at, asked, near = task[lo], [], None
                part = b.slice(lo, hi - lo)
                ids, x = part.column("vec_id").to_numpy(), _matrix(part.column("embedding"), shared.value.shape[2])
                if not row[lo]:
                    asked.append((ids, x))
                    continue
                if near is None and asked:
                    near, asked = Nearest(*(np.concatenate(c) for c in zip(*asked)), shared.value, k, rerank, metric), []
                if near is not None:
                    near.meet(ids, _codes(part.column("codes")), part.column("error").to_numpy(), x)
        if near is not None:
            yield near.batch()

    rows = index.select("vec_id", "codes", "error").join(vectors.select("vec_id", "embedding"), "vec_id")
    return dealt(rows, queries, blocks, lanes).mapInArrow(run, "query_id long, vec_id long, score double")


def search(index: DataFrame, vectors: DataFrame, queries: DataFrame, books: np.ndarray, k: int = 20, rerank: int = RERANK, metric: str = "ip") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest of all rows of the index, itself left out.

    ``index``: from ``build_index`` of ``vectors``; ``vectors`` and ``queries``: (vec_id, embedding), as
    ``usable`` gives them. Equal scores go to the smaller vec_id; fewer rows than k are all
    returned. metric "ip": inner product; "l2": minus the squared distance.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} is none of {METRICS}")
    found = written(checked(index, vectors, queries, books, k, max(rerank, k), metric), "op8-found", max(1, min(ROW_BLOCK, BLOCK_BYTES // (books.shape[2] * 8))))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    books = train(vectors)
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = written(build_index(vectors, books), "op8")
    return search(index, vectors, vectors.where(F.col("vec_id") % 20 == 0), books)
