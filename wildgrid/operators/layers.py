"""Polygon layers whose borders are simplified once, so that neighbours stay neighbours.

A place of a ring is a junction if its neighbours in all rings of the layer are more than two: there
borders part. Rings are cut at junctions into arcs, and each arc is simplified in its own
canonical direction, so the two polygons that share it get the same places without meeting each other.
Only places are shuffled, to find the junctions; each ring is then one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RINGS = "array<array<struct<x:double,y:double>>>"


def junctions(layer: DataFrame) -> DataFrame:
    """(x, y) of the places at which borders of a layer (fid, rings) part."""
    ring = layer.select(F.explode("rings").alias("r")).where(F.size("r") > 2)
    n = F.size("r")
    at = ring.select("r", n.alias("n"), F.posexplode("r").alias("i", "p"))
    sides = at.select("p.x", "p.y", F.explode(F.array(F.get("r", (F.col("i") + 1) % F.col("n")), F.get("r", (F.col("i") + F.col("n") - 1) % F.col("n")))).alias("beside"))
    # three different neighbours are enough, however many rings meet there
    found = sides.where((F.col("beside.x") != F.col("x")) | (F.col("beside.y") != F.col("y"))).distinct().groupBy("x", "y").agg(F.count("*").alias("n"))
    return found.where("n > 2").select("x", "y")


def simplified(layer: DataFrame, tolerance: float) -> DataFrame:
    """The layer (fid, rings, attributes) with rings whose places lie within ``tolerance`` of the former line, as few as that allows.

    Junctions stay. A ring without any keeps its smallest place and that farthest from it. A ring that would shrink to a line is
    left out, a polygon that would lose all of them keeps its largest ring as it was. Repeated places, as of closed rings, count once. Null rings stay null.
    """
    at = layer.select("fid", F.posexplode("rings").alias("ring", "r")).select("fid", "ring", F.posexplode("r").alias("i", "p"))
    joined = at.join(junctions(layer).withColumn("junction", F.lit(True)), (F.col("p.x") == F.col("x")) & (F.col("p.y") == F.col("y")), "left")
    place = F.struct("i", F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.coalesce("junction", F.lit(False)).alias("junction"))
    rings = joined.groupBy("fid", "ring").agg(F.sort_array(F.collect_list(place)).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for places in b.column("places"):
                flat = places.values
                x, y = (flat.field(c).to_numpy() for c in ("x", "y"))
                kept = _ring(np.column_stack([x, y]), flat.field("junction").to_numpy(zero_copy_only=False), tolerance)
                out.append([{"x": float(px), "y": float(py)} for px, py in kept])
            yield pa.RecordBatch.from_arrays([b.column("fid"), b.column("ring"), pa.array(out, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))], names=["fid", "ring", "line"])

    kind = dict(layer.dtypes)["fid"]
    lines = rings.mapInArrow(run, f"fid {kind}, ring int, line array<struct<x:double,y:double>>")
    own = lines.where("size(line) > 2").groupBy("fid").agg(F.transform(F.sort_array(F.collect_list(F.struct("ring", "line"))), lambda r: r["line"]).alias("_lines"))
    largest = F.element_at(F.sort_array(F.transform("rings", lambda r: F.struct(_size(r).alias("size"), r.alias("r")))), -1)["r"]
    out = layer.join(own, "fid", "left")
    kept = F.when(F.col("_lines").isNotNull(), F.col("_lines")).when(F.size("rings") > 0, F.array(largest)).otherwise(F.col("rings"))
    return out.withColumn("rings", kept).select(*layer.columns)


def _size(ring):
    from wildgrid.functions.geometry import ring_area

    return F.when(F.size(ring) > 2, F.abs(ring_area(ring))).otherwise(0.0)


def _ring(places: np.ndarray, junction: np.ndarray, tolerance: float) -> np.ndarray:
    """A ring's places that stay, in its own order and from its own first one that stays."""
    new = np.any(places != np.roll(places, 1, axis=0), axis=1)
    places, junction = places[new], junction[new]
    n = len(places)
    if n < 3:
        return places[:0]
    fixed = np.flatnonzero(junction)
    if len(fixed) < 2:
        # of one ring or of two that share all places: the same two, wherever it begins
        first = fixed[0] if len(fixed) else np.lexsort((places[:, 1], places[:, 0]))[0]
        far = ((places - places[first]) ** 2).sum(1)
        best = np.flatnonzero(far == far.max())
        fixed = np.unique([first, best[np.lexsort((places[best, 1], places[best, 0]))[0]]])
    keep = np.zeros(n, bool)
    for lo, hi in zip(fixed, [*fixed[1:], fixed[0] + n]):
        arc = np.arange(lo, hi + 1) % n
        keep[arc[_arc(places[arc], tolerance)]] = True
    return places[keep] if keep.sum() > 2 else places[:0]


def _arc(line: np.ndarray, tolerance: float) -> np.ndarray:
    """Which places of an open line stay (Douglas-Peucker), the same whichever way it is given."""
    if tuple(line[0]) > tuple(line[-1]) or (tuple(line[0]) == tuple(line[-1]) and line.tolist() > line[::-1].tolist()):
        return _arc(line[::-1], tolerance)[::-1]
    keep = np.zeros(len(line), bool)
    keep[[0, -1]] = True
    todo = [(0, len(line) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        p, step = line[a + 1 : b], line[b] - line[a]
        length = (step**2).sum()
        # to the piece of line between both ends
        u = np.clip(((p - line[a]) @ step) / length, 0, 1)[:, None] if length else np.zeros((len(p), 1))
        apart = ((p - line[a] - u * step) ** 2).sum(1)
        far = int(apart.argmax())
        if apart[far] > tolerance**2:
            keep[a + 1 + far] = True
            todo += [(a, a + 1 + far), (a + 1 + far, b)]
    return keep
