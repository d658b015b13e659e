"""Counts over pairs of species (or of sites) of a presence-absence matrix, tile by tile.

Species are dealt into blocks of about ``BLOCK``; a tile is a pair of blocks, and a dense count
matrix of that size is all that a task ever holds. A site's list of species is cut by block,
and its pieces meet only as pairs of blocks, so a site with very many species is spread over as
many tiles as it touches, and a species at very many sites over salts of the sites, whose
partial tiles are summed. What is wanted of a finished tile (its pairs, its sums, all its covariances)
is made in the task that holds it; labels and marginals come along once a tile, so pairs are never joined to anything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wildgrid.sources import io

BLOCK = 1024
#: Sites of one salt: a tile takes no more lists in one task.
SITES = 200_000
#: Cells of a finished tile that are sent at a time.
SENT = 100_000
_LOW = 16

_ROW = "bi int, bj int, salt int, kind int, a array<int>, b array<int>, names_a array<string>, names_b array<string>, marks_a array<long>, marks_b array<long>"
HEADER, LISTS, PARTIAL = range(3)

Finish = Callable[[np.ndarray, pa.Array, pa.Array, np.ndarray, np.ndarray, bool], Iterator[pa.RecordBatch]]


class Tiles:
    """The tiles of a matrix: ``pam`` (site, species), pairs of ``of``."""

    def __init__(self, pam: DataFrame, of: str = "species", block: int = BLOCK, sites: int = SITES):
        on = "site" if of == "species" else "species"
        spark = pam.sparkSession
        path = io.scratch(spark, "tiles")
        io.write_parquet(pam.select(F.col(of).alias("label"), F.col(on).alias("at")), path)
        held = spark.read.schema(f"label {dict(pam.dtypes)[of]}, at {dict(pam.dtypes)[on]}").parquet(path)
        marginal = held.groupBy("label").agg(F.count("*").alias("mark"))
        self.number, self.total = marginal.count(), held.select("at").distinct().count()
        self.blocks, self.salts = max(1, -(-self.number // block)), max(1, -(-self.total // sites))
        place = Window.partitionBy("block").orderBy("label")
        members = marginal.withColumn("block", F.pmod(F.xxhash64("label"), F.lit(self.blocks)).cast("int")).withColumn("local", F.row_number().over(place) - 1)
        self.tables = members.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("local", F.col("label").cast("string").alias("label"), "mark"))).alias("own"))  # about BLOCK
        self.lists = held.join(members.select("label", "block", "local"), "label").groupBy("at", "block").agg(F.collect_list("local").alias("local"))

    def _headers(self) -> DataFrame:
        """A row for each tile with labels and marginals of both its blocks."""
        side = lambda n: self.tables.select(F.col("block").alias(f"b{n}"), F.expr("transform(own, o -> o.label)").alias(f"names_{n}"), F.expr("transform(own, o -> o.mark)").alias(f"marks_{n}"))
        first = side("a").withColumn("bb", F.explode(F.sequence("ba", F.lit(self.blocks - 1))))
        none = F.lit(None).cast("array<int>")
        rows = first.join(side("b"), "bb")
        return rows.select(F.col("ba").alias("bi"), F.col("bb").alias("bj"), F.lit(0).alias("salt"), F.lit(HEADER).alias("kind"), none.alias("a"), none.alias("b"), "names_a", "names_b", "marks_a", "marks_b")

    def _pairs(self) -> DataFrame:
        """Each site's lists by pairs of blocks."""
        a, b = (self.lists.select("at", F.col("block").alias(f"b{n}"), F.col("local").alias(m)) for n, m in (("i", "a"), ("j", "b")))
        salt = F.pmod(F.xxhash64("at"), F.lit(self.salts)).cast("int")
        names, marks = F.lit(None).cast("array<string>"), F.lit(None).cast("array<long>")
        return a.join(b, "at").where("bi <= bj").select("bi", "bj", salt.alias("salt"), F.lit(LISTS).alias("kind"), "a", "b", names.alias("names_a"), names.alias("names_b"), marks.alias("marks_a"), marks.alias("marks_b"))

    def finished(self, finish: Finish, schema: str, empty: bool = False) -> DataFrame:
        """What ``finish`` makes of every tile, counts and labels given; ``empty``: of those without a shared site too."""
        rows = self._pairs()
        if self.salts > 1:
            rows = self._summed(rows, _partial, _ROW, False).withColumn("salt", F.lit(0))
        return self._summed(rows.unionByName(self._headers()), finish, schema, empty)

    @staticmethod
    def _summed(rows: DataFrame, finish, schema: str, empty: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tile = None
            for batch in batches:
                keys = np.stack([batch.column(c).to_numpy() for c in ("bi", "bj", "salt")], 1) if batch.num_rows else np.empty((0, 3), int)
                starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])) if len(keys) else []
                for lo, hi in zip(starts, [*starts[1:], len(keys)]):
                    key = tuple(map(int, keys[lo]))
                    if tile is None or tile.key != key:
                        if tile is not None and (empty or tile.met):
                            yield from finish(tile)
                        tile = _Tile(key)
                    tile.add(batch.slice(int(lo), int(hi - lo)))
            if tile is not None and (empty or tile.met):
                yield from finish(tile)

        return rows.repartition("bi", "bj", "salt").sortWithinPartitions("bi", "bj", "salt", "kind").mapInArrow(run, schema)


class _Tile:
    """One tile while its rows come in; the header first, where there is one."""

    def __init__(self, key: tuple[int, int, int]):
        self.key, self.met = key, False
        self.counts = np.zeros((64, 64), np.int64)

    def add(self, rows: pa.RecordBatch) -> None:
        kinds = rows.column("kind").to_numpy()
        a, b = rows.column("a"), rows.column("b")
        for k in range(len(kinds)):
            if kinds[k] == HEADER:
                self.names = [rows.column(f"names_{n}").slice(k, 1).flatten() for n in "ab"]
                self.marks = [rows.column(f"marks_{n}").slice(k, 1).flatten().to_numpy() for n in "ab"]
                self._fit(len(self.names[0]), len(self.names[1]))
                continue
            self.met = True
            x, y = (c.slice(k, 1).flatten().to_numpy() for c in (a, b))
            if kinds[k] == LISTS:
                self._fit(int(x.max()) + 1, int(y.max()) + 1)
                self.counts[np.ix_(x, y)] += 1  # a site has a species once
            else:
                i, j = x >> _LOW, x & ((1 << _LOW) - 1)
                self._fit(int(i.max()) + 1, int(j.max()) + 1)
                self.counts[i, j] += y

    def _fit(self, n: int, m: int) -> None:
        have = self.counts.shape
        if n > have[0] or m > have[1]:
            wide = np.zeros((max(have[0], 1 << (n - 1).bit_length()), max(have[1], 1 << (m - 1).bit_length())), np.int64)
            wide[: have[0], : have[1]] = self.counts
            self.counts = wide

    @property
    def whole(self) -> np.ndarray:
        """Counts of the labels that the header names."""
        return self.counts[: len(self.names[0]), : len(self.names[1])]

    def labelled(self, r: np.ndarray, c: np.ndarray, values: np.ndarray, name: str) -> Iterator[pa.RecordBatch]:
        """Rows (i, j, value), i before j, a limited number at a time."""
        both = np.array(self.names[0].to_pylist() + self.names[1].to_pylist(), object)
        place = np.empty(len(both), np.int64)
        place[np.argsort(both)] = np.arange(len(both))
        words = pa.concat_arrays([x.cast(pa.string()) for x in self.names])
        for lo in range(0, len(r), SENT):
            x, y = r[lo : lo + SENT], c[lo : lo + SENT] + len(self.names[0])
            swap = place[x] > place[y]
            yield pa.RecordBatch.from_arrays([words.take(pa.array(np.where(swap, y, x))), words.take(pa.array(np.where(swap, x, y))), pa.array(values[lo : lo + SENT])], names=["i", "j", name])


def _partial(tile: _Tile) -> Iterator[pa.RecordBatch]:
    r, c = np.nonzero(tile.counts)
    lists = lambda x: pa.array([x.astype(np.int32)], pa.list_(pa.int32()))
    number = lambda x: pa.array([x], pa.int32())
    text, marks = pa.array([None], pa.list_(pa.string())), pa.array([None], pa.list_(pa.int64()))
    columns = [number(tile.key[0]), number(tile.key[1]), number(0), number(PARTIAL), lists(r << _LOW | c), lists(tile.counts[r, c]), text, text, marks, marks]
    yield pa.RecordBatch.from_arrays(columns, names=["bi", "bj", "salt", "kind", "a", "b", "names_a", "names_b", "marks_a", "marks_b"])


def _upper(tile: _Tile, counts: np.ndarray, k: int = 1) -> np.ndarray:
    """Of a tile on the diagonal only the upper half counts."""
    return np.triu(counts, k) if tile.key[0] == tile.key[1] else counts


def shared(pam: DataFrame, of: str = "species", **sizes: int) -> DataFrame:
    """(i, j, n), i < j: sites that two species share (or species that two sites share), pairs with none left out."""

    def finish(tile: _Tile) -> Iterator[pa.RecordBatch]:
        counts = _upper(tile, tile.whole)
        r, c = np.nonzero(counts)
        yield from tile.labelled(r, c, counts[r, c], "n")

    return Tiles(pam, of, **sizes).finished(finish, "i string, j string, n long")


def overlap_sums(pam: DataFrame, of: str = "species", **sizes: int) -> DataFrame:
    """(squares, weighted): over all pairs i < j that share n, the sums of n * n and of n times both marginals. One row a tile; no pair leaves its task."""

    def finish(tile: _Tile) -> Iterator[pa.RecordBatch]:
        n = _upper(tile, tile.whole)
        weighted = int(n.sum(1) @ tile.marks[0]) + int(n.sum(0) @ tile.marks[1])
        yield pa.RecordBatch.from_arrays([pa.array([int((n * n).sum())]), pa.array([weighted])], names=["squares", "weighted"])

    return Tiles(pam, of, **sizes).finished(finish, "squares long, weighted long")


def covariances(pam: DataFrame, of: str = "species", **sizes: int) -> DataFrame:
    """(i, j, sigma), i <= j, of all pairs, with those that share nothing and each with itself: the whole symmetric matrix, streamed tile by tile."""
    tiles = Tiles(pam, of, **sizes)
    total = tiles.total

    def finish(tile: _Tile) -> Iterator[pa.RecordBatch]:
        n = tile.whole
        sigma = n / total - (tile.marks[0] / total)[:, None] * (tile.marks[1] / total)[None]
        r, c = np.nonzero(_upper(tile, np.ones(n.shape, bool), 0))
        yield from tile.labelled(r, c, sigma[r, c], "sigma")

    return tiles.finished(finish, "i string, j string, sigma double", True)
