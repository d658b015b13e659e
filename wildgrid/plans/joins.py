"""Queries: spatial joins, register joins, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from wildgrid.functions import text as X
from wildgrid.functions import geometry as G
from wildgrid.operators import records, register, spatial

from .query import Queries
from .views import POLY, annotated, annotated_table, domain, layer, view, with_views

Q = Queries()
POINTS = ("gbifid", "lon", "lat")


def _points(spark, d):
    return domain(spark, d, "occ").select(*POINTS)


@Q.add("spatial_join_county", "select gbifid, p.fid, p.name, stusps from occ join poly p on abs(lon - mx) + abs(lat - my) < r", "occ", "poly")
def _(spark, d):
    return spatial.spatial_join(_points(spark, d), layer(spark, d, "poly"), "name", "stusps").select("gbifid", "fid", "name", "stusps")


@Q.add("spatial_join_aiannh", "select gbifid, p.fid, p.name, geoid from occ join native p on abs(lon - mx) + abs(lat - my) < r", "occ", "native")
def _(spark, d):
    return spatial.spatial_join(_points(spark, d), layer(spark, d, "native"), "name", "geoid").select("gbifid", "fid", "name", "geoid")


@Q.add("update_by_key", "select gbifid, taxonkey, name as census_county from occ left join (select gbifid, min(p.name) as name from occ join poly p on abs(lon - mx) + abs(lat - my) < r group by 1) using (gbifid)", "occ", "poly")
def _(spark, d):
    occ = domain(spark, d, "occ").select("gbifid", "taxonkey", "lon", "lat")
    return spatial.update_by_key(occ, layer(spark, d, "poly"), {"census_county": "name"}, "name").drop("lon", "lat")


@Q.add("cross_filter_spatial", "select gbifid, p.fid from occ join poly p on abs(lon - mx) + abs(lat - my) < r", "occ", "poly")
def _(spark, d):
    """The theta form: any predicate between points and whole polygons, behind the cells that both touch."""
    return spatial.theta_filter(_points(spark, d), layer(spark, d, "poly"), G.contains(F.col("edges"), F.col("lon"), F.col("lat"))).select("gbifid", "fid")


@Q.add("riis_region", "select gbifid, census_state, case when census_state in ('AK', 'HI') then census_state when census_state is not null then 'L48' end as riis_region from ann", "ann")
def _(spark, d):
    return annotated(spark, d).select("gbifid", "census_state", "riis_region")


@Q.add("riis_join", "select gbifid, riis_region, taxonkey, riis_occurrence_id, riis_assessment from ann where riis_occurrence_id is not null", "ann")
def _(spark, d):
    return annotated(spark, d).where("riis_occurrence_id is not null").select("gbifid", "riis_region", "taxonkey", "riis_occurrence_id", "riis_assessment")


@Q.add("presumed_native", "select gbifid, riis_region, riis_assessment from ann where riis_assessment = 'presumed_native'", "ann")
def _(spark, d):
    return annotated(spark, d).where("riis_assessment = 'presumed_native'").select("gbifid", "riis_region", "riis_assessment")


_KEYS = "select gbifid, case gbifid % 3 when 0 then 'AK' when 1 then 'HI' else 'L48' end as riis_region, taxonkey as k1, case when gbifid % 2 = 0 then (taxonkey + 5) % 97 end as k2 from occ"


@Q.add("riis_multi_key", f"""> q as ({_KEYS}), e as (select gbifid, riis_region, 0 as pos, k1 as k from q union all select gbifid, riis_region, 1, k2 from q where k2 is not null),
h as (select e.gbifid, arg_max(lower(degreeofestablishment), pos * 100000000 + occurrenceid) as a from e join riis on locality = riis_region and try_cast(gbif_res_taxonkey as int) = k group by 1)
select gbifid, coalesce(a, 'presumed_native') as assessment from q left join h using (gbifid)""", "occ", "riis")
def _(spark, d):
    o = domain(spark, d, "occ")
    region = F.when(F.col("gbifid") % 3 == 0, "AK").when(F.col("gbifid") % 3 == 1, "HI").otherwise("L48")
    keys = F.when(F.col("gbifid") % 2 == 0, F.array("taxonkey", (F.col("taxonkey") + 5) % 97)).otherwise(F.array("taxonkey"))
    return register.assess_keys(o.select("gbifid", region.alias("riis_region"), keys.alias("keys")), domain(spark, d, "riis"), "gbifid", most=2).select("gbifid", "assessment")


@Q.add("riis_assessments_map", """> o as (select try_cast(gbif_res_taxonkey as int) as key, locality, arg_max(degreeofestablishment, occurrenceid) as a from riis where try_cast(gbif_res_taxonkey as int) is not null group by 1, 2)
select key, string_agg(locality || '=' || a, ',' order by locality) as assessments from o group by 1""", "riis")
def _(spark, d):
    m = register.assessment_map(domain(spark, d, "riis"))
    text = F.array_join(F.transform(F.map_entries("assessments"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return m.select("key", text.alias("assessments"))


_DIST = """> e as (select fid, mx + x1 * r as x1, my + y1 * r as y1, mx + x2 * r as x2, my + y2 * r as y2, mx, my, r
 from poly, (values (1, 0, 0, 1), (0, 1, -1, 0), (-1, 0, 0, -1), (0, -1, 1, 0)) v(x1, y1, x2, y2)),
u as (select gbifid, fid, abs(lon - mx) + abs(lat - my) < r as inside, lon, lat, x1, y1, x2, y2, least(1, greatest(0, ((lon - x1) * (x2 - x1) + (lat - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) as t
 from (select * from occ where gbifid % 4 = 0 and lon is not null and lat is not null) o, e),
s as (select gbifid, fid, case when bool_or(inside) then 0.0::double else round(min(sqrt(pow(lon - (x1 + t * (x2 - x1)), 2) + pow(lat - (y1 + t * (y2 - y1)), 2))), 9) end as d from u group by 1, 2)
select gbifid, arg_min(fid, d * 1000 + fid / 1000000.0) as fid, min(d) as distance from s where d <= 1.0 group by 1"""


@Q.add("nearest_polygon", _DIST.replace("where gbifid % 4 = 0 and", "where"), "occ", "poly")
def _(spark, d):
    near = spatial.nearest_polygon(_points(spark, d), layer(spark, d, "poly"), "gbifid", 1.0)
    return near.select("gbifid", "fid", F.round("distance", 9).alias("distance"))


@Q.add("nearest_polygon_rings", f"""{_DIST.replace("where gbifid % 4 = 0 and", "where").rsplit(chr(10) + "select", 1)[0]},
b as (select gbifid, min(d) as least from s group by 1)
select gbifid, fid, d as distance, case when d = 0 then 0.0::double when least <= 0.3 then 0.3 when least <= 1.0 then 1.0 when least <= 2.8 then 2.8 else 5.5 end as ring from s join b using (gbifid) where d - least <= 1e-9 and least <= 5.5""", "occ", "poly")
def _(spark, d):
    """The search that widens from ring to ring, to 5.5 degrees, with all polygons as near as the nearest."""
    return spatial.nearest_polygons(_points(spark, d), layer(spark, d, "poly"), "gbifid").select("gbifid", "fid", F.round("distance", 9).alias("distance"), "ring")


@Q.add("spatial_join_refined", "select gbifid, p.fid, p.name, stusps from occ join poly p on abs(lon - mx) + abs(lat - my) < r", "occ", "poly")
def _(spark, d):
    """The join over cells that are quartered while the points in them times their edges exceed a bound."""
    points = _points(spark, d)
    own = spatial.index(layer(spark, d, "poly"), "name", "stusps", cell=20.0)
    return spatial.spatial_join(points, spatial.refined(own, 50_000, points)).select("gbifid", "fid", "name", "stusps")


_BORDER = "select c_custkey, mx + r * u as lon, my + r * (1 - abs(u)) * s as lat from (select c_custkey, c_nationkey, (c_custkey % 17 - 8) / 8.0D as u, case when c_custkey % 2 = 0 then 1 else -1 end as s from customer) c join poly on fid = c_nationkey"


@Q.add("spatial_join_closed", f"> b as ({_BORDER.replace('8.0D', '8.0::double')}) select c_custkey, p.fid, p.name from b join poly p on abs(lon - mx) + abs(lat - my) <= r", "poly")
def _(spark, d):
    """Points on borders and corners (every customer on the border of the own nation's land), with all polygons that touch them."""
    points = view(spark, d, _BORDER.replace("join poly", f"join ({POLY}) p"))
    return spatial.spatial_join(points, layer(spark, d, "poly"), "name", closed=True).select("c_custkey", "fid", "name")


@Q.add("first_polygon", "select gbifid, min(p.name) as name from occ join poly p on abs(lon - mx) + abs(lat - my) < r group by 1", "occ", "poly")
def _(spark, d):
    found = spatial.spatial_join(_points(spark, d), layer(spark, d, "poly"), "name")
    return spatial.first_polygon(found.select("gbifid", "name"), "gbifid", "name")


@Q.add("pad_min_gap", "> s as (select gbifid, lon, lat, census_state as state from ann) select gbifid, min(gap) as gap, arg_min(a.name, gap || a.name) as name from s join areas a using (state) where abs(lon - mx) + abs(lat - my) < r group by 1", "ann", "areas")
def _(spark, d):
    points = annotated_table(spark, d).select("gbifid", "lon", "lat", F.col("census_state").alias("state"))
    return spatial.min_gap(points, layer(spark, d, "areas"), "gbifid")


@Q.add("terr_marine_fill", """> h as (select gbifid, least(count(*), 2) as n, min(p.name) as name from occ join poly p on abs(lon - mx) + abs(lat - my) < r group by 1),
m as (select gbifid, least(count(*), 2) as n, min(p.name) as name from occ join areas p on abs(lon - mx) + abs(lat - my) < r group by 1)
select gbifid, case when h.n = 1 then h.name end as place, case when coalesce(h.n, 0) <> 1 and m.n = 1 then m.name end as region, cast(case when h.n = 1 then 1 else coalesce(m.n, 0) end as int) as match_count
from occ left join h using (gbifid) left join m using (gbifid)""", "occ", "poly", "areas")
def _(spark, d):
    return spatial.land_then_sea(_points(spark, d), layer(spark, d, "poly"), layer(spark, d, "areas")).select("gbifid", "place", "region", "match_count")


# --- lookups --------------------------------------------------------------------

_ITIS = "select distinct p_name as clean_name, concat('T', cast(p_size as string)) as tsn, 'Plantae' as kingdom from part where p_partkey % 3 = 0"
_TAXA = "select l_orderkey as id, l_linenumber as n, p_name as clean_name, 'unknown' as kingdom from lineitem join part on l_partkey = p_partkey"


@Q.add("itis_lookup", f"with i as (select clean_name, min(tsn) as tsn, min(kingdom) as kingdom from ({_ITIS}) group by 1), t as ({_TAXA}) select id, n, clean_name, i.tsn, coalesce(i.kingdom, t.kingdom) as kingdom from t left join i using (clean_name)")
def _(spark, d):
    lookup = view(spark, d, _ITIS).groupBy("clean_name").agg(F.min("tsn").alias("tsn"), F.min("kingdom").alias("kingdom"))
    return records.fill(view(spark, d, _TAXA), lookup, "clean_name", ["tsn", "kingdom"]).select("id", "n", "clean_name", "tsn", "kingdom")


_MEANS = """select p_partkey as line, case when p_partkey % 4 = 0 then '' else cast(p_partkey % 97 as string) end as tsn, p_name as name,
case when p_size % 2 = 0 then 'a' else '' end as ak, case when p_size % 3 = 0 then 'h' end as hi, 'l' as l48 from part"""
_MEANS_SQL = f"p as ({_MEANS}), m as (select coalesce(nullif(tsn, ''), nullif(name, '')) as key, arg_min(concat_ws(' ', nullif(ak, ''), nullif(hi, ''), nullif(l48, '')), line) as means from p group by 1)"


@Q.add("estmeans_build", f"with {_MEANS_SQL} select * from m")
def _(spark, d):
    return records.estimated_means(view(spark, d, _MEANS))


@Q.add("estmeans_lookup", "> " + _MEANS_SQL + " select gbifid, coalesce(a.means, b.means) as means from occ left join m a on a.key = cast(taxonkey as string) left join m b on b.key = species", "occ")
def _(spark, d):
    m = records.estimated_means(view(spark, d, _MEANS))
    o = domain(spark, d, "occ").select("gbifid", "species", F.col("taxonkey").cast("string").alias("tsn"))
    return records.fallback_lookup(o, [(m, "tsn", "key"), (m, "species", "key")], "means").select("gbifid", "means")


_CENTROIDS = "select n_nationkey as line, case when n_nationkey % 2 = 0 then cast(n_nationkey as string) end as fips, concat('S', cast(n_regionkey as string)) as state, n_name as county, concat('POINT (', cast(n_nationkey as string), ' ', cast(n_regionkey as string), ')') as wkt from nation"
_LOST = """select c_custkey as id, cast(c_nationkey as string) as fips, concat('S', cast(n_regionkey as string)) as state, n_name as county, case when c_custkey % 3 = 0 then cast(1 as double) end as lon, case when c_custkey % 3 = 0 then cast(2 as double) end as lat,
case when c_custkey % 6 = 0 then 'county' when c_custkey % 6 = 3 then 'other' end as centroid from customer join nation on c_nationkey = n_nationkey"""


@Q.add("centroid_lookup", f"""with c as ({_CENTROIDS}), r as ({_LOST}), k as (select line::double as x, cast(string_split(replace(replace(wkt, 'POINT (', ''), ')', ''), ' ')[2] as double) as y, fips, state || ';' || county as place from c),
j as (select r.id, case when coalesce(centroid, '') <> 'county' then lon end as lon, case when coalesce(centroid, '') <> 'county' then lat end as lat, case when coalesce(centroid, '') <> 'county' then centroid end as centroid, coalesce(a.x, b.x) as x, coalesce(a.y, b.y) as y
 from r left join k a on a.fips = r.fips left join k b on b.place = r.state || ';' || r.county)
select id, case when lon is null and x is not null then x else lon end as lon, case when lon is null and x is not null then y else lat end as lat, case when lon is null and x is not null then 'county' else centroid end as centroid, case when lon is null and x is not null then 'WGS84' end as datum from j""")
def _(spark, d):
    return records.centroid_lookup(view(spark, d, _LOST), view(spark, d, _CENTROIDS), "id").select("id", "lon", "lat", "centroid", "datum")


@Q.add("name_lookup_discard", """> n as (select cast(k as bigint) as taxon_key, 'Clean ' || cast(k as string) as clean from generate_series(0, 19) g(k)), v as (select distinct provided_name, 'By name' as clean from raw where id % 4 = 0 and provided_name is not null)
select id, coalesce(v.clean, n.clean) as clean from raw left join v using (provided_name) left join n using (taxon_key) where coalesce(v.clean, n.clean) is not null""", "raw")
def _(spark, d):
    raw = domain(spark, d, "raw").select("id", "provided_name", "taxon_key")
    by_name = raw.where("id % 4 = 0 and provided_name is not null").select(F.col("provided_name").alias("k"), F.lit("By name").alias("clean")).distinct()
    by_key = spark.range(20).select(F.col("id").alias("k"), F.concat(F.lit("Clean "), F.col("id").cast("string")).alias("clean"))
    return records.fallback_lookup(raw, [(by_name, "provided_name", "k"), (by_key, "taxon_key", "k")], "clean").where("clean is not null").select("id", "clean")


_SETS = "select distinct source as dataset_id, case when length(source) % 2 = 0 then 'org-own' else 'org-other' end as org_id, concat('https://own/', source) as resource_url from documents where source <> 'src3'"


@Q.add("provider_resource_fill", f"with s as ({_SETS}) select doc_id, source as dataset_id, org_id, case org_id when 'org-own' then 'Own' when 'org-other' then 'Other' end as provider from documents left join s on source = dataset_id where not coalesce(org_id = 'org-own' and starts_with(resource_url, 'https://own/src1'), false)")
def _(spark, d):
    sets = view(spark, d, _SETS)
    orgs = spark.createDataFrame([("org-own", "Own"), ("org-other", "Other")], "org_id string, provider string")
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.col("source").alias("dataset_id"))
    return records.provider_resource(docs, sets, orgs, "org-own", "https://own/src1").select("doc_id", "dataset_id", "org_id", "provider")


@Q.add("missing_ids", "select distinct source from documents where source not in (select source from documents where doc_id % 40 = 0)")
def _(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return records.missing_ids(docs, docs.where("doc_id % 40 = 0").select("source").distinct(), "source")


_OLD = "select concat('u', cast(s_suppkey as string)) as uuid, case when s_suppkey % 5 = 0 then '-9999' else concat('l', cast(s_suppkey as string)) end as legacy_id, concat('old ', s_name) as name from supplier where s_suppkey % 3 <> 0"
_NEW = "select case when s_suppkey % 4 = 0 then concat('v', cast(s_suppkey as string)) else concat('u', cast(s_suppkey as string)) end as uuid, case when s_suppkey % 5 = 0 then '-9999' else concat('l', cast(s_suppkey as string)) end as legacy_id, concat('new ', s_name) as name from supplier where s_suppkey % 2 = 0"


@Q.add("merged_lookup", f"""with o as ({_OLD}), n as ({_NEW}), m as (select coalesce(a.uuid, b.uuid, o.uuid) as uuid, o.legacy_id, coalesce(a.name, b.name, o.name) as name from o left join n a on a.uuid = o.uuid left join n b on a.uuid is null and b.legacy_id = o.legacy_id and b.legacy_id <> '-9999'),
u as (select * from m union all select uuid, legacy_id, name from n where uuid not in (select uuid from m))
select uuid, legacy_id, name, case when legacy_id = '-9999' then uuid else legacy_id end as key from u""")
def _(spark, d):
    return records.merged_lookup(view(spark, d, _OLD), view(spark, d, _NEW), ["name"]).select("uuid", "legacy_id", "name", "key")


_MATCHES = """select concat('Sp ', cast(p_partkey % 97 as string)) as query_name, p_brand as kingdom, min(p_partkey) as pk from part group by 1, 2"""


def _resolve_tables(spark, d):
    m = view(spark, d, _MATCHES)
    k = F.col("pk")
    alt = F.array(F.struct(F.lit("SYNONYM").alias("status"), (k + 1).cast("int").alias("key"), (k + 2).cast("int").alias("accepted_key"), F.lit("syn").alias("name")), F.struct(F.when(k % 2 == 0, "ACCEPTED").otherwise("DOUBTFUL").alias("status"), (k + 3).cast("int").alias("key"), F.lit(None).cast("int").alias("accepted_key"), F.concat(F.lit("alt "), "query_name").alias("name")))
    matches = m.select("query_name", "kingdom", F.when(k % 7 == 0, "NONE").otherwise("EXACT").alias("match_type"), F.when(k % 3 == 0, "ACCEPTED").otherwise("SYNONYM").alias("status"), k.cast("int").alias("usage_key"), F.col("query_name").alias("usage_name"), F.when(k % 3 == 1, (k * 10).cast("int")).alias("accepted_key"), alt.alias("alternatives"))
    names = m.select(F.col("query_name").alias("name"), "kingdom", k.cast("int").alias("old_key"))
    by_key = m.select((k * 10).cast("int").alias("key"), F.concat(F.lit("acc "), (k * 10).cast("string")).alias("name"))
    return names, matches, by_key


_RESOLVED = f"""m as ({_MATCHES}), t as (select query_name as name, kingdom, cast(pk as int) as old_key,
 case when pk % 7 = 0 then null when pk % 3 = 0 then pk when pk % 3 = 1 then pk * 10 when pk % 2 = 0 then pk + 3 else pk + 2 end as nk,
 case when pk % 7 = 0 then null when pk % 3 = 0 then query_name when pk % 3 = 1 then null when pk % 2 = 0 then 'alt ' || query_name end as nn from m),
res as (select t.name, t.kingdom, old_key, cast(nk as int) as new_key, coalesce(nn, 'acc ' || cast(b.pk * 10 as string)) as new_name from t left join m b on b.pk * 10 = nk)"""


@Q.add("riis_taxon_resolve", f"with {_RESOLVED} select * from res")
def _(spark, d):
    return register.resolve(*_resolve_tables(spark, d)).select("name", "kingdom", "old_key", "new_key", "new_name")


@Q.add("riis_report", f"with {_RESOLVED} select count(*) as records, count(distinct name) as taxa, count(*) - count(new_key) as failed, count(new_key) as resolved, count(case when new_key is not null and new_key is distinct from old_key then 1 end) as updated, count(*) as written from res")
def _(spark, d):
    return register.report(register.resolve(*_resolve_tables(spark, d)))


_REG = "select p_partkey as line, p_partkey // 2 as occurrenceid, case when p_partkey % 3 = 0 then null else p_partkey % 97 end as key, p_name as name, case p_size % 3 when 0 then 'AK' when 1 then 'HI' else 'L48' end as locality, p_type as assessment from part where p_partkey % 4 = 0"


def _register(spark, d):
    return view(spark, d, _REG.replace("p_partkey // 2", "p_partkey div 2"))


@Q.add("riis_group_by_taxon", f"with r as ({_REG}), o as (select occurrenceid, arg_max(coalesce(cast(key as string), name), line) as taxon from r group by 1) select taxon, string_agg(cast(occurrenceid as string), ',' order by occurrenceid) as ids from o group by 1")
def _(spark, d):
    return register.grouped(_register(spark, d)).select("taxon", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@Q.add("riis_duplicates", f"""with r as ({_REG}) select a.line as a_line, b.line as b_line, a.key is not distinct from b.key as same_key, a.locality = b.locality as same_locality, a.locality = b.locality and a.assessment = b.assessment as same_assessment_locality,
a.key is not distinct from b.key and a.locality = b.locality and a.assessment = b.assessment as duplicate from r a join r b on a.name = b.name and a.line < b.line""")
def _(spark, d):
    return register.duplicates(_register(spark, d))


@Q.add("riis_typing", "> k as (select *, case when coalesce(gbif_res_taxonkey, '') = '' then -1 else try_cast(gbif_res_taxonkey as int) end as key from riis) select occurrenceid, key, key is null as bad from k", "riis")
def _(spark, d):
    return register.typed(domain(spark, d, "riis")).select("occurrenceid", "key", "bad")


@Q.add("unresolved_to_source", "select o.gbifid, o.lon, o.lat, o.datasetkey from ann join occ o using (gbifid) where census_state is null", "ann")
def _(spark, d):
    lost = annotated_table(spark, d).where("census_state is null").select("gbifid")
    return domain(spark, d, "occ").join(lost, "gbifid", "left_semi").select("gbifid", "lon", "lat", "datasetkey")


_PREFIX = "https://host/ipt/resource?r"


@Q.add("resource_actions_build", f"""> t as (select distinct lang as dataset, 'rename' as action, 'ticket-' || lang as ticket_id from raw where lang in ('en', 'xx')), e as (select lang as dataset, id as line,
 case when len(string_split(resource_url, '=')) = 2 and string_split(resource_url, '=')[1] = '{_PREFIX}' then string_split(resource_url, '=')[2] end as rid from raw),
o as (select dataset, arg_min(rid, line) filter (where rid is not null) as rid from e group by 1)
select coalesce(t.dataset, o.dataset) as dataset, coalesce(action, 'rewrite') as action, coalesce(ticket_id, rid, 'legacy-' || o.dataset) as resource_id from t full join o on t.dataset = o.dataset""", "raw")
def _(spark, d):
    raw = domain(spark, d, "raw").select(F.col("lang").alias("dataset"), "resource_url", F.col("id").alias("line"))
    sets = raw.select("dataset").distinct()
    tickets = sets.where("dataset in ('en', 'xx')").select("dataset", F.lit("rename").alias("action"), F.concat(F.lit("ticket-"), "dataset").alias("ticket_id"))
    legacy = sets.select("dataset", F.concat(F.lit("legacy-"), "dataset").alias("legacy_id"))
    return records.resource_actions(tickets, raw, legacy, _PREFIX)


@Q.add("parsed_name_merge", """> n as (select distinct p_name as name, [length(p_name) % 7, length(p_name) % 5] as ks from part),
p as (select distinct p_name as name, 'parsed ' || p_name as canonical from part where length(p_name) % 2 = 0),
k as (select x as key, 'key ' || cast(x as string) as by_key from generate_series(0, 3) g(x))
select n.name, coalesce(p.canonical, a.by_key, b.by_key) as canonical from n left join p using (name) left join k a on a.key = ks[1] left join k b on b.key = ks[2]""".replace("> n", "with n", 1))
def _(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_name").alias("name")).distinct()
    n = F.length("name")
    names = part.select("name", F.array(n % 7, n % 5).alias("keys"))
    parsed = part.where(n % 2 == 0).select("name", F.concat(F.lit("parsed "), "name").alias("canonical"))
    by_key = spark.range(4).select(F.col("id").cast("int").alias("key"), F.concat(F.lit("key "), F.col("id").cast("string")).alias("canonical"))
    return records.merged_names(names, parsed, by_key)
