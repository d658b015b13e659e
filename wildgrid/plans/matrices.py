"""Queries: matrices of region by species, and diversity statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from wildgrid.functions import geometry as G
from wildgrid.operators import diversity as D
from wildgrid.operators import layers
from wildgrid.operators import matrix as M
from wildgrid.operators import spatial
from wildgrid.sources import io

from .query import Queries
from .views import domain, layer

Q = Queries()
LEAST = 8
SITE, SPECIES = "3_BUILDING", "part 1"
EXTENT, SIZE = (-25, -25, 25, 25), 5.0


def _cells(spark, d):
    return M.build(domain(spark, d, "stacked"), "site", "species", "n")


def _pam(spark, d):
    return D.presence(_cells(spark, d), LEAST)


def _labels(column):
    return F.array_join(column, ",")


# --- cells ------------------------------------------------------------------------


@Q.add("heatmap_build", "select * from cells", "cells")
def _(spark, d):
    return _cells(spark, d)


@Q.add("heatmap_filter", "select * from cells where value >= 6 and value <= 10", "cells")
def _(spark, d):
    return M.keep_between(_cells(spark, d), 6, 10)


@Q.add("matrix_shape", "select count(distinct row) as rows, count(distinct col) as cols from cells", "cells")
def _(spark, d):
    return M.shape(_cells(spark, d))


_FIRST = "(select min(row) from cells)"


@Q.add("vector_by_label", f"select col as label, value from cells where row = {_FIRST}", "cells")
def _(spark, d):
    cells = _cells(spark, d)
    return M.vector(cells, cells.agg(F.min("row")).first()[0])


for _axis, _own in M.AXES.items():

    @Q.add(f"vector_{'sum' if _axis == 0 else 'count'}", f"select {_own} as label, sum(value)::bigint as total, count(*) as count from cells group by 1", "cells")
    def _(spark, d, axis=_axis):
        return M.vector_sums(_cells(spark, d), axis)

    @Q.add(f"vector_{'sum' if _axis == 0 else 'count'}_ge", f"select {_own} as label, sum(value)::bigint as total, count(*) as count from cells where value >= 9 group by 1", "cells")
    def _(spark, d, axis=_axis):
        return M.vector_sums(_cells(spark, d), axis, 9)


@Q.add("row_labels_for_value", "select row as label from cells where col = (select min(col) from cells) and value = 8", "cells")
def _(spark, d):
    cells = _cells(spark, d)
    return M.row_labels(cells, cells.agg(F.min("col")).first()[0], 8)


@Q.add("extreme_labels", """> m as (select row, max(value) as value from cells group by 1)
select row as label, value, string_agg(col, ',' order by col) as labels from cells join m using (row, value) group by 1, 2""", "cells")
def _(spark, d):
    return M.extremes(_cells(spark, d)).withColumn("labels", _labels("labels"))


def _one(axis):
    own, other = M.AXES[axis], M.AXES[1 - axis]
    return f"""a as (select {own}, sum(value)::bigint as total, count(*) as count, min(value) as least, max(value) as most from cells group by 1),
o as (select {own} as label, total, count, least, most, count(case when value = least then 1 end) as n_least, string_agg(case when value = most then {other} end, ',' order by {other}) as most_labels from cells join a using ({own}) group by all)"""


def _all(axis):
    own = M.AXES[axis]
    stats = ", ".join(f"{f}({k}) as {n}_{k}" for k in ("count", "total") for n, f in (("min", "min"), ("mean", "avg"), ("median", "median"), ("max", "max")))
    at = ", ".join(f"count(case when {k} = min_{k} then 1 end) as n_min_{k}, string_agg(case when {k} = max_{k} then label end, ',' order by label) as max_{k}_labels" for k in ("count", "total"))
    return f"""v as (select {own} as label, sum(value)::bigint as total, count(*) as count from cells group by 1), w as (select count(*) as vectors, sum(total)::bigint as grand_total, {stats} from v),
x as (select w.*, q.* from w, (select {at} from v, w) q)"""


def _flat(df):
    return df.withColumns({n: _labels(n) for n, t in df.dtypes if t.startswith("array")})


for _axis, _name in ((0, "row"), (1, "col")):

    @Q.add(f"{_name}_stats_one", f"> {_one(_axis)} select * from o", "cells")
    def _(spark, d, axis=_axis):
        return _flat(M.one_stats(_cells(spark, d), axis))

    @Q.add(f"{_name}_extremes_all", f"> v as (select {M.AXES[_axis]} as label, sum(value)::bigint as total, count(*) as count from cells group by 1) " + " union all ".join(f"select '{k}' as measure, '{n}' as extreme, label, {k} as value from v where {k} = (select {n}({k}) from v)" for k in ("count", "total") for n in ("min", "max")), "cells")
    def _(spark, d, axis=_axis):
        return M.all_extremes(_cells(spark, d), axis)

    @Q.add(f"{_name}_stats_all", f"> {_all(_axis)} select * from x", "cells")
    def _(spark, d, axis=_axis):
        return _flat(M.all_stats(_cells(spark, d), axis))

    @Q.add(f"compare_{'row' if _axis == 0 else 'column'}", f"> {_one(_axis)}, {_all(_axis)} select o.*, x.* from o, x where o.label = (select min({M.AXES[_axis]}) from cells)", "cells")
    def _(spark, d, axis=_axis):
        cells = _cells(spark, d)
        return _flat(M.compare(cells, cells.agg(F.min(M.AXES[axis])).first()[0], axis))


@Q.add("axis_totals", "select col as label, sum(value)::bigint as total from cells group by 1", "cells")
def _(spark, d):
    return M.axis_totals(_cells(spark, d), 1)


@Q.add("axis_counts", "select row as label, count(*) as count from cells group by 1", "cells")
def _(spark, d):
    return M.axis_counts(_cells(spark, d), 0)


@Q.add("random_labels", "select row as label from (select distinct row from cells) q order by md5('1:' || row), row limit 5", "cells")
def _(spark, d):
    return M.random_labels(_cells(spark, d), 5)


@Q.add("summary_matrix", "select 'species' as axis, col as label, sum(value)::bigint as total, count(*) as count from cells group by 2 union all select 'region', row, sum(value)::bigint, count(*) from cells group by 2", "cells")
def _(spark, d):
    cells = _cells(spark, d)
    return M.summary(cells, 0).withColumn("axis", F.lit("species")).unionByName(M.summary(cells, 1).withColumn("axis", F.lit("region")))


@Q.add("summary_row", "select col as label, sum(value)::bigint as total, count(*) as count from cells where col = (select max(col) from cells) group by 1", "cells")
def _(spark, d):
    cells = _cells(spark, d)
    return M.summary_row(M.summary(cells, 0), cells.agg(F.max("col")).first()[0])


@Q.add("summary_measures", "select count(*) as items, 2 as measures from (select distinct col from cells) q", "cells")
def _(spark, d):
    s = M.summary(_cells(spark, d), 0)
    return s.agg(F.count("*").alias("items")).withColumn("measures", F.lit(len(s.columns) - 1))


@Q.add("rank_measures", "> s as (select col as label, sum(value)::bigint as total, count(*) as count from cells group by 1), r as (select *, cast(rank() over (order by total desc) as int) as rank from s) select * from r where rank <= 10", "cells")
def _(spark, d):
    return M.rank(M.summary(_cells(spark, d), 0), "total")


Q.functions["top_k_ties"], Q.sql["top_k_ties"] = Q.functions["rank_measures"], Q.sql["rank_measures"]


@Q.add("matrix_concat", "> a as (select row as label, sum(value)::bigint as v0 from cells group by 1), b as (select row as label, count(*) as v1 from cells where value >= 9 group by 1) select label, v0, v1 from a full join b using (label)", "cells")
def _(spark, d):
    cells = _cells(spark, d)
    return M.concat_columns(M.axis_totals(cells).withColumnRenamed("total", "value"), M.axis_counts(M.keep_between(cells, 9)).withColumnRenamed("count", "value"))


_FLAGS = ("N", "A", "R")


@Q.add("pivot_species", "select l_linestatus as row, " + ", ".join(f"coalesce(sum(case when l_returnflag = '{f}' then 1 end), 0)::bigint as {f}" for f in _FLAGS) + " from lineitem group by 1")
def _(spark, d):
    cells = M.build(spark.read.parquet(f"{d}/lineitem.parquet").withColumn("n", F.lit(1).cast("long")), "l_linestatus", "l_returnflag", "n")
    return M.pivot(cells, list(_FLAGS))


@Q.add("matrix_save_load", "> r as (select row, row_number() over (order by row) - 1 as row_id from (select distinct row from cells)), c as (select col, row_number() over (order by col) - 1 as col_id from (select distinct col from cells)) select row, col, value, row_id, col_id from cells join r using (row) join c using (col)", "cells")
def _(spark, d):
    """Cells as numbers in blocks of rows beside their ordered labels, written as one bundle, read again and labelled."""
    path = io.scratch(spark, "matrix")
    io.write_bundle(M.encoded(_cells(spark, d)), path, {"value": "n", "dims": ["site", "species"]}, {"cells": "block"})
    tables, meta = io.read_bundle(spark, path)
    if not {"cells", "rows", "cols"} <= set(meta["tables"]):
        raise ValueError("labels are missing")
    return M.decoded(tables)


@Q.add("summary_save_load", "select col as label, sum(value)::bigint as total, count(*) as count from cells group by 1", "cells")
def _(spark, d):
    path = io.scratch(spark, "summary")
    io.write_bundle({"summary": M.summary(_cells(spark, d), 0)}, path)
    return io.read_bundle(spark, path)[0]["summary"]


@Q.add("dq_matrix_consistency", "select 'x' as rule, 'x' as label, 0::bigint as expected, 0::bigint as found where 1 = 0")
def _(spark, d):
    return M.consistency(domain(spark, d, "stacked"), "site", "species", "n", LEAST)


@Q.add("describe", f"> {_one(0)} select * from o where label = (select min(row) from cells)", "cells")
def _(spark, d):
    cells = _cells(spark, d)
    return _flat(M.describe(cells, cells.agg(F.min("row")).first()[0]))


# --- diversity ----------------------------------------------------------------------

_MARGINS = f"""pam as (select row as site, col as species from cells where value >= {LEAST}), al as (select site, count(*) as alpha from pam group by 1), om as (select species, count(*) as omega from pam group by 1),
z as (select count(distinct species) as S, count(distinct site) as N from pam)"""


def _stat(name, sql, f):
    Q.add(name, f"> {_MARGINS} {sql}", "cells")(lambda spark, d: f(_pam(spark, d)))


def _rounded(df):
    return df.withColumns({n: F.round(n, 9) for n, t in df.dtypes if t == "double"})


_stat("pam_build", "select site, species from pam", lambda p: p)
_stat("pam_num_species", "select S as n from z", lambda p: D.sizes(p).select(F.col("S").alias("n")))
_stat("pam_num_sites", "select N as n from z", lambda p: D.sizes(p).select(F.col("N").alias("n")))
_stat("pam_alpha", "select * from al", D.alpha)
_stat("pam_omega", "select * from om", D.omega)
_SITE_SQL = "select site, alpha, round(alpha / S, 9) as alpha_proportional, round(S / alpha, 9) as beta, phi, round(phi / (N * alpha), 9) as phi_average_proportional from (select site, count(*) as alpha, sum(omega)::bigint as phi from pam join om using (species) group by 1) q, z"
_SPECIES_SQL = "select species, omega, round(omega / N, 9) as omega_proportional, psi, round(psi / (S * omega), 9) as psi_average_proportional from (select species, count(*) as omega, sum(alpha)::bigint as psi from pam join al using (site) group by 1) q, z"
_stat("pam_site_stats", _SITE_SQL, lambda p: _rounded(D.site_stats(p)))
_stat("pam_species_stats", _SPECIES_SQL, lambda p: _rounded(D.species_stats(p)))
for _n, _c in (("alpha_proportional", "alpha_proportional"), ("beta", "beta"), ("phi", "phi"), ("phi_avg_proportional", "phi_average_proportional")):
    _stat(f"pam_{_n}", f"select site, {_c} from ({_SITE_SQL}) t", lambda p, c=_c: _rounded(D.site_stats(p).select("site", c)))
for _n, _c in (("omega_proportional", "omega_proportional"), ("psi", "psi"), ("psi_avg_proportional", "psi_average_proportional")):
    _stat(f"pam_{_n}", f"select species, {_c} from ({_SPECIES_SQL}) t", lambda p, c=_c: _rounded(D.species_stats(p).select("species", c)))

_ONE = """select S, N, round(S / (so / N), 9) as whittaker, round(S - so / N, 9) as lande, round(so - soo / N, 9) as legendre,
round((saa / N - pow(so / N, 2)) / (so / N - soo / (N * N)), 9) as schluter_species, round((soo / S - pow(sa / S, 2)) / (sa / S - saa / (S * S)), 9) as schluter_sites
from (select count(*)::double as S, sum(omega)::double as so, sum(omega * omega)::double as soo from om) o, (select count(*)::double as N, sum(alpha)::double as sa, sum(alpha * alpha)::double as saa from al) a"""
_stat("pam_diversity_stats", f"select S::bigint as S, N::bigint as N, whittaker, lande, legendre, schluter_species, schluter_sites from ({_ONE}) t", lambda p: _rounded(D.diversity_stats(p)))
for _c in ("whittaker", "lande", "legendre", "schluter_species", "schluter_sites"):
    _stat(f"pam_{_c}", f"select {_c} from ({_ONE}) t", lambda p, c=_c: _rounded(D.diversity_stats(p).select(c)))

_stat("pam_c_score", """select round(2 * sum((a.omega - coalesce(q.c, 0)) * (b.omega - coalesce(q.c, 0))) / (max(S) * (max(S) - 1)), 9) as c_score
from om a join om b on a.species < b.species left join (select x.species as i, y.species as j, count(*) as c from pam x join pam y on x.site = y.site and x.species < y.species group by 1, 2) q on i = a.species and j = b.species, z""", lambda p: _rounded(D.c_score(p)))
_SIGMA = """select i, j, round(c / {size} - (a.{m} / {size}) * (b.{m} / {size}), 9) as sigma from (select x.{of} as i, y.{of} as j, count(*) as c from pam x join pam y on x.{on} = y.{on} and x.{of} <= y.{of} group by 1, 2) q
join {t} a on a.{of} = i join {t} b on b.{of} = j, z"""
_stat("pam_sigma_species", _SIGMA.format(size="N", m="omega", of="species", on="site", t="om"), lambda p: _rounded(D.sigma(p)))
_stat("pam_sigma_sites", _SIGMA.format(size="S", m="alpha", of="site", on="species", t="al"), lambda p: _rounded(D.sigma(p, "site")))
_stat("pam_covariance_stats", f"select 'species' as axis, * from ({_SIGMA.format(size='N', m='omega', of='species', on='site', t='om')}) a union all select 'site', * from ({_SIGMA.format(size='S', m='alpha', of='site', on='species', t='al')}) b", lambda p: _rounded(D.sigma(p).withColumn("axis", F.lit("species")).unionByName(D.sigma(p, "site").withColumn("axis", F.lit("site")))))


_WHOLE = """select '{of}' as axis, a.{of} as i, b.{of} as j, round(coalesce(c, 0) / {size} - (a.{m} / {size}) * (b.{m} / {size}), 9) as sigma from {t} a join {t} b on a.{of} <= b.{of}
left join (select x.{of} as i, y.{of} as j, count(*) as c from pam x join pam y on x.{on} = y.{on} and x.{of} <= y.{of} group by 1, 2) q on q.i = a.{of} and q.j = b.{of}, z"""


@Q.add("pam_covariance_matrix", f"> {_MARGINS} {_WHOLE.format(size='N', m='omega', of='species', on='site', t='om')} union all {_WHOLE.format(size='S', m='alpha', of='site', on='species', t='al')}", "cells")
def _(spark, d):
    """Both whole symmetric matrices, written by axis and read again."""
    pam, path = _pam(spark, d), io.scratch(spark, "covariances")
    for of in ("species", "site"):
        io.write_parquet(D.covariance_matrix(pam, of), f"{path}/axis={of}")
    return _rounded(spark.read.schema("i string, j string, sigma double, axis string").parquet(path))


@Q.add("stats_save_load", f"> {_MARGINS} {_SITE_SQL}", "cells")
def _(spark, d):
    pam = _pam(spark, d)
    path = io.scratch(spark, "stats")
    io.write_bundle({"site": D.site_stats(pam), "species": D.species_stats(pam), "diversity": D.diversity_stats(pam)}, path, {"least": LEAST})
    return _rounded(io.read_bundle(spark, path)[0]["site"])


@Q.add("job_matrix", f"> {_MARGINS} {_SPECIES_SQL}", "cells")
def _(spark, d):
    """Cells written once; summaries, presence and all statistics from them."""
    path = io.scratch(spark, "job-matrix")
    io.write_bundle({"cells": _cells(spark, d)}, path)
    cells = io.read_bundle(spark, path)[0]["cells"]
    pam = D.presence(cells, LEAST)
    io.write_bundle({"species_summary": M.summary(cells, 0), "region_summary": M.summary(cells, 1), "species": D.species_stats(pam), "site": D.site_stats(pam), "diversity": D.diversity_stats(pam)}, f"{path}/stats", {"least": LEAST})
    return _rounded(io.read_bundle(spark, f"{path}/stats")[0]["species"])


# --- grids and polygon tables ---------------------------------------------------------

_GRID = f"g as (select cast(floor((lon + 25) / {SIZE}) as int) as gx, cast(floor((25 - lat) / {SIZE}) as int) as gy, species, count(*) as value from occ where lon >= -25 and lon < 25 and lat > -25 and lat <= 25 and species is not null group by 1, 2, 3)"
_GRID_ALL = "c as (select cast(x as int) as gx, cast(y as int) as gy from generate_series(0, 9) a(x), generate_series(0, 9) b(y))"


def _heat(spark, d):
    return spatial.grid_heatmap(domain(spark, d, "occ"), EXTENT, SIZE)


@Q.add("grid_heatmap", f"> {_GRID} select * from g", "occ")
def _(spark, d):
    return _heat(spark, d)


@Q.add("grid_pam", f"> {_GRID} select gx, gy, species from g", "occ")
def _(spark, d):
    return spatial.grid_pam(_heat(spark, d))


for _n, _v, _e in (("species", "species_count", "count(species)"), ("point", "point_count", "coalesce(sum(value), 0)")):

    @Q.add(f"grid_{_n}_counts", f"> {_GRID}, {_GRID_ALL} select gx, gy, {_e}::bigint as {_v} from c left join g using (gx, gy) group by 1, 2", "occ")
    def _(spark, d, v=_v):
        return spatial.grid_sums(_heat(spark, d), EXTENT, SIZE).select("gx", "gy", v)


@Q.add("site_index", "> h as (select fid, count(*) as n from occ join poly p on abs(lon - mx) + abs(lat - my) < r group by 1) select fid, stusps || '__' || name as site, round(mx, 6) as x, round(my, 6) as y, coalesce(n, 0) as points from poly left join h using (fid)", "occ", "poly")
def _(spark, d):
    poly = layer(spark, d, "poly")
    hits = spatial.spatial_join(domain(spark, d, "occ").select("gbifid", "lon", "lat"), poly).groupBy("fid").agg(F.count("*").alias("points"))
    sites = spatial.site_index(poly, "stusps", "name")
    found = spatial.with_absent(sites, sites.join(hits, "fid").select("site", "points"), "points")
    return found.select("fid", "site", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "points")


@Q.add("cell_cover", "select fid, cast(x as bigint) as cx, cast(y as bigint) as cy from poly, generate_series(-20, 20) a(x), generate_series(-20, 20) b(y) where x between floor((mx - r) / 2.5) and floor((mx + r) / 2.5) and y between floor((my - r) / 2.5) and floor((my + r) / 2.5)", "poly")
def _(spark, d):
    return G.cover(layer(spark, d, "poly"), 2.5).select("fid", "cx", "cy")


@Q.add("polygon_explode", """select fid, name, piece::int as piece, rings::int as rings, round(part * r * r, 9) as area
from poly, (values (0, 1, 0.125::double), (1, 2, 1.5), (2, 2, 0.375)) v(piece, rings, part)""", "poly")
def _(spark, d):
    """A county with a lake, an island in the lake, and a second part with a lake of its own: three simple polygons with their holes."""
    def ring(dx: float, size: float):
        return F.transform(F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((1, 0), (0, 1), (-1, 0), (0, -1))]), lambda p: F.struct((F.col("mx") + (dx + p["x"] * size) * F.col("r")).alias("x"), (F.col("my") + p["y"] * size * F.col("r")).alias("y")))

    rings = F.array(ring(0, 0.25), ring(0, 1), ring(0, 0.5), ring(2.5, 0.25), ring(2.5, 0.5))
    parts = G.pieces(domain(spark, d, "poly").select("fid", "name", rings.alias("rings")))
    own = F.transform("rings", lambda r: F.abs(G.ring_area(r)))
    area = F.get(own, 0) * 2 - F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    return parts.select("fid", "name", "piece", F.size("rings").alias("rings"), F.round(area, 9).alias("area"))


@Q.add("layer_simplified", """with s as (select n_nationkey as fid, n_nationkey // 5 as j from nation where n_nationkey < 25)
select fid, cast(4 + 3 * ((j > 0)::int + (j < 4)::int) as int) as places, 100.0::double + 1.25 * ((j < 4)::int - (j > 0)::int) as area from s""")
def _(spark, d):
    """Squares side by side; inner borders from left to right have a spike of 1 degree, whose three places stay in both neighbours, all borders small bends, which go."""
    cells = spark.read.parquet(f"{d}/nation.parquet").where("n_nationkey < 25").select(F.col("n_nationkey").alias("fid"), (F.col("n_nationkey") % 5).alias("i"), F.floor(F.col("n_nationkey") / 5).alias("j"))
    steps = F.sequence(F.lit(0), F.lit(7))

    def bend(k, line, last):
        """How far the k-th eighth of a border lies off its line: small ones everywhere, 1 in the middle of an inner one."""
        return F.when(k % 8 == 0, 0.0).when((k == 4) & (line > 0) & (line < last), 1.0).otherwise((k % 3 - 1) * 0.02)

    def across(j, forward: bool):
        return F.transform(steps, lambda k: (lambda e: F.struct(((F.col("i") + e / 8) * 10).alias("x"), (j * 10 + bend(e, j, 5)).cast("double").alias("y")))(k if forward else 8 - k))

    def upward(i, forward: bool):
        return F.transform(steps, lambda k: (lambda e: F.struct((i * 10 + bend(e, F.lit(0), 5)).cast("double").alias("x"), ((F.col("j") + e / 8) * 10).alias("y")))(k if forward else 8 - k))

    ring = F.concat(across(F.col("j"), True), upward(F.col("i") + 1, True), across(F.col("j") + 1, False), upward(F.col("i"), False))
    out = layers.simplified(cells.select("fid", F.array(ring).alias("rings")), 0.2)
    r = F.get("rings", 0)
    return out.select("fid", F.size(r).alias("places"), F.round(F.abs(G.ring_area(r)), 9).alias("area"))


@Q.add("merged_layers", "select fid, name, stusps, cast(null as varchar) as geoid from poly union all select fid, name, null, geoid from native", "poly", "native")
def _(spark, d):
    return spatial.merged_layers(layer(spark, d, "poly").select("fid", "name", "stusps"), layer(spark, d, "native").select("fid", "name", "geoid"))


@Q.add("polygon_centroid_bbox", "select fid, round(mx, 6) as x, round(my, 6) as y, mx - r as xmin, mx + r as xmax, my - r as ymin, my + r as ymax, (select min(mx - r) from poly) as all_xmin, (select max(mx + r) from poly) as all_xmax, (select min(my - r) from poly) as all_ymin, (select max(my + r) from poly) as all_ymax from poly", "poly")
def _(spark, d):
    found = spatial.centres_and_extent(layer(spark, d, "poly"))
    return found.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})
