"""Points and polygons in column expressions: no Python, no geometry library.

A polygon is ``edges``, array<struct<x1,y1,x2,y2>>, of all its rings, so holes and
multipolygons need nothing more. Containment counts edge crossings: a point on a
border belongs to one side only (half-open); ``on_edge`` tells exactly whether it lies on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def edges(rings: Column) -> Column:
    """Edges of array<array<struct<x,y>>>; open rings are closed, edges without length left out."""
    def ring(r: Column) -> Column:
        n = F.size(r)
        def edge(i: Column) -> Column:
            a, b = F.get(r, i), F.get(r, (i + 1) % n)
            return F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))
        return F.filter(F.transform(F.sequence(F.lit(0), n - 1), edge), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 2), ring))


def crossings(e: Column, lon: Column, lat: Column) -> Column:
    """How many edges a ray from the point towards larger x crosses."""
    def crossed(k: Column) -> Column:
        return ((k["y1"] > lat) != (k["y2"] > lat)) & (lon < (k["x2"] - k["x1"]) * (lat - k["y1"]) / (k["y2"] - k["y1"]) + k["x1"])
    return F.size(F.filter(e, crossed))


#: Rounding of a difference of two products of differences is no more than this share of the products' sum.
_ROUNDING = 3.3306690738754716e-16
#: Places of the exact test lie on multiples of 2^-52 degrees: those of 1 degree and more from the axes do as they are, nearer ones move by less than that.
_GRID = 2.0**52


def on_edge(k: Column, lon: Column, lat: Column) -> Column:
    """Whether a point lies on an edge, both ends included.

    The sign of the area of the three places is certain where it is larger than what rounding could make;
    else it is found again in whole numbers, whose products fit 38 digits for all places on the globe.
    """
    left, right = (k["x1"] - lon) * (k["y2"] - lat), (k["y1"] - lat) * (k["x2"] - lon)
    sure = F.abs(left - right) > (F.abs(left) + F.abs(right)) * _ROUNDING

    def whole(c: Column) -> Column:
        return F.rint(c * _GRID).cast("long")

    def product(a: Column, b: Column) -> Column:
        return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")

    x, y = whole(lon), whole(lat)
    flat = product(whole(k["x1"]) - x, whole(k["y2"]) - y) == product(whole(k["y1"]) - y, whole(k["x2"]) - x)
    within = lon.between(F.least(k["x1"], k["x2"]), F.greatest(k["x1"], k["x2"])) & lat.between(F.least(k["y1"], k["y2"]), F.greatest(k["y1"], k["y2"]))
    return F.when(within & ~sure, flat).otherwise(False)


def contains(e: Column, lon: Column, lat: Column) -> Column:
    return crossings(e, lon, lat) % 2 == 1


def distance(e: Column, lon: Column, lat: Column) -> Column:
    """To the nearest edge; infinite without edges."""
    def to(k: Column) -> Column:
        dx, dy = k["x2"] - k["x1"], k["y2"] - k["y1"]
        u = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((lon - k["x1"]) * dx + (lat - k["y1"]) * dy) / (dx * dx + dy * dy)))
        return F.sqrt(F.pow(lon - (k["x1"] + u * dx), 2) + F.pow(lat - (k["y1"] + u * dy), 2))
    return F.coalesce(F.array_min(F.transform(e, to)), F.lit(float("inf")))


def bounds(e: Column) -> dict[str, Column]:
    xs = F.concat(F.transform(e, lambda k: k["x1"]), F.transform(e, lambda k: k["x2"]))
    ys = F.concat(F.transform(e, lambda k: k["y1"]), F.transform(e, lambda k: k["y2"]))
    return {"xmin": F.array_min(xs), "xmax": F.array_max(xs), "ymin": F.array_min(ys), "ymax": F.array_max(ys)}


def centre(e: Column) -> tuple[Column, Column]:
    """Centroid by the shoelace sums; rings run the way their interior asks for."""
    def total(f):
        return F.aggregate(F.transform(e, f), F.lit(0.0), lambda a, v: a + v)
    cross = lambda k: k["x1"] * k["y2"] - k["x2"] * k["y1"]
    area = total(cross) * 3
    return total(lambda k: (k["x1"] + k["x2"]) * cross(k)) / area, total(lambda k: (k["y1"] + k["y2"]) * cross(k)) / area


def cover(layer: DataFrame, cell: float, widen: float = 0.0, *keep: str) -> DataFrame:
    """(fid, edges, ...) -> a row for each grid cell that a polygon's (widened) envelope touches: cx, cy, fid, envelope, kept columns."""
    b = layer.select("fid", *keep, *[v.alias(k) for k, v in bounds(F.col("edges")).items()])
    def run(lo: Column, hi: Column) -> Column:
        return F.explode(F.sequence(F.floor((lo - widen) / cell), F.floor((hi + widen) / cell)))
    b = b.withColumn("cx", run(F.col("xmin"), F.col("xmax")))
    return b.withColumn("cy", run(F.col("ymin"), F.col("ymax")))


def _span(axis: str, cell: float, by: float = 0.0) -> tuple[str, str]:
    """The first and the last cell along an axis that an edge (widened) meets."""
    a, b = f"e.{axis}1", f"e.{axis}2"
    return f"floor((least({a}, {b}) - {by}D) / {cell!r}D)", f"floor((greatest({a}, {b}) + {by}D) / {cell!r}D)"


def _needed(cell: float) -> dict[str, str]:
    """``edges`` that a ray from a point of the cell (cx, cy) may cross, and the parity ``crossed`` of those that it surely crosses."""
    (low, high), (left, right) = _span("y", cell), _span("x", cell)
    sure = f"({low} < cy and {high} > cy and {left} > cx + 1)"
    return {"crossed": f"size(filter(edges, e -> {sure})) % 2", "edges": f"filter(edges, e -> {low} <= cy and {high} >= cy and {right} >= cx - 1 and not {sure})"}


def clipped_cover(layer: DataFrame, cell: float, widen: float = 0.0, *keep: str) -> DataFrame:
    """``cover`` with what a point of the cell needs of its polygon.

    ``edges`` are those that a ray from such a point may cross; ``crossed`` is 1 if it surely crosses
    an odd number of others, which pass the cell's whole row to its right; ``near`` (with ``widen``) are the edges within
    that distance. A cell wholly inside a polygon has no edges and crossed 1; cells wholly outside (and not near) are left out.
    Cells are compared one column wider than need be, so that rounding can't tell a ray from its edge.
    """
    (low, high), (left, right) = _span("y", cell, widen), _span("x", cell, widen)
    near = f"filter(edges, e -> cy between {low} and {high} and cx between {left} and {right})" if widen else f"cast(null as array<{EDGE}>)"
    out = cover(layer, cell, widen, "edges", *keep).withColumns({c: F.expr(e) for c, e in {"near": near, **_needed(cell)}.items()})
    return out.where("size(edges) > 0 or crossed = 1 or size(near) > 0")


def clipped(rows: DataFrame, cell: float) -> DataFrame:
    """Rows of ``clipped_cover`` (without near) moved to smaller cells inside their own: cx, cy of these are given, edges and crossed are those of the larger ones."""
    before = rows.withColumn("_crossed", F.col("crossed")).withColumns({c: F.expr(e) for c, e in _needed(cell).items()})
    return before.withColumn("crossed", (F.col("crossed") + F.col("_crossed")) % 2).drop("_crossed").where("size(edges) > 0 or crossed = 1")


def ring_area(r: Column) -> Column:
    """Signed area of a ring array<struct<x,y>>: positive where it runs against the clock."""
    n = F.size(r)
    def cross(i: Column) -> Column:
        a, b = F.get(r, i), F.get(r, (i + 1) % n)
        return a["x"] * b["y"] - b["x"] * a["y"]
    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), cross), F.lit(0.0), lambda t, v: t + v) / 2


def _within(a: Column, b: Column) -> Column:
    """Whether ring a lies in ring b: most middles of its edges do, and its area is smaller. Rings of a layer don't cross, but may touch."""
    middles = F.transform(a["edges"], lambda e: F.struct(((e["x1"] + e["x2"]) / 2).alias("x"), ((e["y1"] + e["y2"]) / 2).alias("y")))
    inside = F.size(F.filter(middles, lambda m: contains(b["edges"], m["x"], m["y"])))
    return (a["area"] < b["area"]) & (2 * inside > F.size(a["edges"]))


def pieces(layer: DataFrame, rings: str = "rings") -> DataFrame:
    """Multipolygons as simple polygons with the same attributes: piece (its number, in the order of outer rings), rings (outer ring, then its holes).

    A ring inside an even number of others is an outer ring, one inside an odd number is a hole of the smallest that
    holds it, so an island in a hole is a piece of its own, whichever way rings run. Rings of fewer than three
    places are left out; a polygon without rings has no piece.
    """
    others = [c for c in layer.columns if c != rings]
    known = F.transform(F.filter(rings, lambda r: F.size(r) > 2), lambda r: F.struct(r.alias("ring"), edges(F.array(r)).alias("edges"), F.abs(ring_area(r)).alias("area")))
    out = layer.select(*others, known.alias("_rings"))
    # of each ring: the places of those that hold it
    above = F.transform("_rings", lambda a: F.filter(F.transform("_rings", lambda b, i: F.when(_within(a, b), i)), lambda i: i.isNotNull()))
    out = out.withColumn("_above", above)
    out = out.select(*others, "_rings", "_above", F.posexplode("_rings").alias("_at", "_outer")).where(F.size(F.get("_above", F.col("_at"))) % 2 == 0)
    depth = F.size(F.get("_above", F.col("_at")))
    holes = F.filter(F.transform("_rings", lambda h, i: F.when(F.array_contains(F.get("_above", i), F.col("_at")) & (F.size(F.get("_above", i)) == depth + 1), h["ring"])), lambda r: r.isNotNull())
    number = F.size(F.filter(F.transform("_above", lambda a, i: (i < F.col("_at")) & (F.size(a) % 2 == 0)), lambda x: x))
    return out.select(*others, number.alias("piece"), F.concat(F.array(F.col("_outer.ring")), holes).alias(rings))
