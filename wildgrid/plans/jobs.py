"""Composite jobs: whole compositions of the operators, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildgrid.functions import text as X
from wildgrid.operators import counts, diversity, matrix, records, register, spatial
from wildgrid.sources import io

from .joins import _DIST, _PREFIX, _SETS
from .query import Queries
from .views import ANN, KEYED, annotated, domain, layer, view

Q = Queries()
_RANKED = "taxonrank in ('SPECIES', 'SUBSPECIES', 'VARIETY', 'FORM', 'INFRASPECIFIC_NAME', 'INFRASUBSPECIFIC_NAME')"


# --- the register ------------------------------------------------------------------

#: What a taxonomic backbone says to each key of the register: none, accepted, or a synonym of another key.
_BACKBONE = """bb as (select distinct key, case when key % 7 = 0 then null when key % 3 = 0 then key else (key * 10) % 97 end as new_key
 from (select try_cast(gbif_res_taxonkey as int) as key from riis) q where key is not null)"""
_RESOLVED = f"""{_BACKBONE}, rr as (select locality, occurrenceid, degreeofestablishment, riis.gbif_res_taxonkey as old_key, cast(bb.new_key as varchar) as gbif_res_taxonkey
 from riis left join bb on bb.key = try_cast(riis.gbif_res_taxonkey as int))"""


def resolved_register(riis: DataFrame) -> DataFrame:
    """Register rows with their accepted keys as gbif_res_taxonkey (null where the backbone has no match), and old_key."""
    key = F.col("gbif_res_taxonkey").try_cast("int")
    rows = riis.withColumn("name", key.cast("string")).withColumn("kingdom", F.lit("any"))
    names = rows.where("name is not null").select("name", "kingdom", F.col("name").cast("int").alias("old_key")).distinct()
    k = F.col("old_key")
    none = F.array().cast("array<struct<status:string,key:int,accepted_key:int,name:string>>")
    matches = names.select(F.col("name").alias("query_name"), "kingdom", F.when(k % 7 == 0, "NONE").otherwise("EXACT").alias("match_type"), F.when(k % 3 == 0, "ACCEPTED").otherwise("SYNONYM").alias("status"), k.alias("usage_key"), F.col("name").alias("usage_name"), F.when(k % 3 != 0, (k * 10) % 97).alias("accepted_key"), none.alias("alternatives"))
    by_key = matches.where("accepted_key is not null").select(F.col("accepted_key").alias("key"), F.concat(F.lit("taxon "), F.col("accepted_key").cast("string")).alias("name")).distinct()
    found = register.resolve(names, matches, by_key).select("name", "new_key")
    out = rows.join(found, "name", "left")
    return out.select("locality", "occurrenceid", "degreeofestablishment", F.col("gbif_res_taxonkey").alias("old_key"), F.col("new_key").cast("string").alias("gbif_res_taxonkey"))


@Q.add("job_annotate_riis", f"> {_RESOLVED} select occurrenceid::varchar as occurrenceid, old_key, cast(gbif_res_taxonkey as int) as new_key, locality from rr where try_cast(old_key as int) is not null", "riis")
def _(spark: SparkSession, d: str) -> DataFrame:
    """The register read as text, its keys resolved, written under its date and read again."""
    path = io.scratch(spark, "register")
    raw = domain(spark, d, "riis")
    io.write_csv(raw, f"{path}/in", raw.columns)
    typed = register.typed(io.register_csv(spark, f"{path}/in", raw.columns)).where("not bad and key >= 0").drop("key", "bad")
    out = resolved_register(typed).withColumnRenamed("gbif_res_taxonkey", "new_key")
    io.write_csv(out, f"{path}/2024_01_01", ["occurrenceid", "old_key", "new_key", "locality"])
    return io.csv(spark, f"{path}/2024_01_01", "occurrenceid string, old_key string, new_key int, locality string")


_ANN2 = f"{_RESOLVED}, keyed2 as ({KEYED.replace('from riis', 'from rr')}), ann2 as ({ANN.replace('keyed', 'keyed2')})"


def _monthly_sql() -> str:
    """Each product as its delivered file has it: the line's position beside it, once for Parquet and once for CSV."""
    parts = []
    for name, (regions, more, is_list) in counts.PRODUCTS.items():
        region = regions[0]
        if is_list:
            group = ", ".join(dict.fromkeys([*regions, "taxonkey_species", "taxonkey", "species", "riis_assessment"]))
            of = f"select {region} as location, riis_assessment, species, taxonkey_species, count(*) as occ_count, null::bigint as species_count from ann2 where census_state is not null and species is not null group by {group}"
            order = "location, species, taxonkey_species, riis_assessment"
        else:
            status = "riis_assessment" if more else "null::varchar"
            of = f"select {region} as location, {status} as riis_assessment, null::varchar as species, null::varchar as taxonkey_species, count(*) as occ_count, count(distinct taxonkey) as species_count from ann2 where {region} is not null and species is not null group by {', '.join([region, *more])}"
            order = "location, riis_assessment"
        order = ", ".join(f"{c} nulls first" for c in order.split(", "))
        parts.append(f"select '{name}' as sink, kind, row_number() over (partition by kind order by {order}) - 1 as position, location, riis_assessment, species, occ_count, species_count from ({of}) q, (values ('parquet'), ('csv')) k(kind)")
    return f"> {_ANN2}\n" + " union all\n".join(parts)


@Q.add("job_monthly", _monthly_sql(), "ann")
def _(spark: SparkSession, d: str) -> DataFrame:
    """The register resolved, the subset annotated with it and written; from that table all counts and lists, each made once as a table and
    delivered as one ordered Parquet file and one ordered CSV file with header; what was delivered is read again, with each line's place in its file."""
    path = io.scratch(spark, "monthly")
    io.write_parquet(annotated(spark, d, resolved_register(domain(spark, d, "riis"))), f"{path}/annotated")
    ann = spark.read.parquet(f"{path}/annotated")
    back = []
    for sink in counts.PRODUCTS:
        made, order = counts.product(ann, sink)
        io.write_parquet(made, f"{path}/{sink}/table")
        made = spark.read.schema(made.schema).parquet(f"{path}/{sink}/table")
        for kind in ("parquet", "csv"):
            io.write_sorted(made, f"{path}/{sink}/{kind}", *order, kind=kind)
            rows = spark.read.schema(made.schema).parquet(f"{path}/{sink}/{kind}") if kind == "parquet" else io.csv(spark, f"{path}/{sink}/{kind}", made.schema.simpleString()[7:-1].replace(":", " "))
            have = [F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (("riis_assessment", "string"), ("species", "string"), ("occ_count", "long"), ("species_count", "long"))]
            back.append(io.in_file_order(rows).select(F.lit(sink).alias("sink"), F.lit(kind).alias("kind"), "position", F.col(order[0]).alias("location"), *have))
    return matrix.concat_rows(*back)


# --- records ------------------------------------------------------------------------

_NEAR, _NEAREST = _DIST.replace("where gbifid % 4 = 0 and", "where").rsplit("\nselect", 1)
_NEAR = f"{_NEAR.removeprefix('> ')}, near as (select {_NEAREST})"


@Q.add("job_annotate_records", f"""> {_NEAR}, k as (select gbifid, taxonkey, lon, lat, case when gbifid % 2 = 0 and taxonrank <> 'SPECIES' then (taxonkey + 5) % 97 end as k2 from occ where {_RANKED}),
a as (select k.*, near.fid, near.distance, stusps as state, case when stusps in ('AK', 'HI') then stusps when stusps is not null then 'L48' end as riis_region from k left join near using (gbifid) left join poly on poly.fid = near.fid),
ek as (select gbifid, riis_region, 0 as pos, taxonkey as k from a union all select gbifid, riis_region, 1, k2 from a where k2 is not null),
h as (select ek.gbifid, arg_max(lower(degreeofestablishment), pos * 100000000 + occurrenceid) as assessment from ek join riis on locality = riis_region and try_cast(gbif_res_taxonkey as int) = k group by 1),
p as (select gbifid, min(gap) as gap, arg_min(areas.name, gap || areas.name) as area from a join areas using (state) where abs(lon - areas.mx) + abs(lat - areas.my) < areas.r group by 1)
select 'record' as what, cast(a.gbifid as varchar) as value, 1::bigint as n, a.fid, a.distance, state, coalesce(assessment, 'presumed_native') as assessment, gap, area from a left join h using (gbifid) left join p using (gbifid) union all
select 'failed_id', cast(gbifid as varchar), 1, null, null, null, null, null, null from a where fid is null union all
select 'rank', taxonrank, count(*), null, null, null, null, null, null from occ where not {_RANKED} group by 2""", "occ", "poly", "riis", "areas")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Accepted ranks with their keys, the nearest county, the register by both keys, protected areas; and the report of what failed."""
    occ = domain(spark, d, "occ").withColumns({"rank": F.col("taxonrank"), "accepted_key": F.col("taxonkey"), "species_key": F.when(F.col("gbifid") % 2 == 0, (F.col("taxonkey") + 5) % 97)})
    kept = records.taxon_keys(occ).select("gbifid", "keys", "lon", "lat")
    poly = layer(spark, d, "poly")
    near = spatial.with_nearest(kept, poly.withColumnRenamed("stusps", "state"), 1.0, "state")
    located = near.select("gbifid", "keys", "lon", "lat", "nearest.fid", F.round("nearest.distance", 9).alias("distance"), "nearest.state")
    assessed = register.assess_keys(located.withColumn("riis_region", register.region_of(F.col("state"))), domain(spark, d, "riis"), "gbifid", most=2)
    out = spatial.with_min_gap(assessed, layer(spark, d, "areas"))
    path = io.scratch(spark, "annotated-records")
    io.write_parquet(out.select("gbifid", "fid", "distance", "state", "assessment", "area.gap", F.col("area.name").alias("area")), path)
    done = spark.read.parquet(path)
    rows = done.select(F.lit("record").alias("what"), F.col("gbifid").cast("string").alias("value"), F.lit(1).cast("long").alias("n"), "fid", "distance", "state", "assessment", "gap", "area")
    report = counts.annotate_report(done, F.col("fid").isNotNull(), "gbifid", records.rejected_ranks(occ.select("rank")))
    return rows.unionByName(report, allowMissingColumns=True)


@Q.add("job_inspect_record", f"> {_NEAR} select o.gbifid, o.taxonkey, o.census_county, near.fid as nearest_fid, near.distance from ann o left join near using (gbifid) where gbifid = (select min(gbifid) from ann where census_county is not null)", "ann")
def _(spark: SparkSession, d: str) -> DataFrame:
    """One record by its id, with the nearest polygon to its point; only that record is annotated."""
    sub = records.subset(domain(spark, d, "occ"))
    placed = spatial.with_polygons(sub.select("gbifid", "lon", "lat"), spatial.index(layer(spark, d, "poly")))
    first = placed.where(F.size("polygons") > 0).agg(F.min("gbifid")).first()[0]
    one = annotated(spark, d, where=F.col("gbifid") == first).limit(1).select("gbifid", "taxonkey", "census_county", "lon", "lat")
    near = spatial.nearest_polygon(one.select("gbifid", "lon", "lat"), layer(spark, d, "poly"), "gbifid", 1.0)
    return one.join(near, "gbifid", "left").select("gbifid", "taxonkey", "census_county", F.col("fid").alias("nearest_fid"), F.round("distance", 9).alias("distance"))


# --- cleaning -------------------------------------------------------------------------

#: Whole degrees lie on borders of the diamonds, where both sides' rules differ; points are moved off them.
_MOVED = "case when {0} = '0' then {0} else concat({0}, '{1}') end"
_LON, _LAT = _MOVED.format("lon", ".25"), _MOVED.format("lat", ".35")
_NUMBERS = "select cast(k as bigint) as taxon_key, 'Clean ' || cast(k as varchar) as clean from generate_series(0, 19) g(k)"
_LOOKUPS = f"""nk as ({_NUMBERS}), nn as (select distinct provided_name, 'By name' as clean from raw where id % 4 = 0 and provided_name is not null),
it as (select clean as clean_name, 'T' || cast(taxon_key as varchar) as tsn from nk where taxon_key % 3 = 0),
em as (select coalesce(case when taxon_key % 2 = 0 then 'T' || cast(taxon_key as varchar) end, clean) as key, concat_ws(' ', case when taxon_key % 2 = 0 then 'a' end, case when taxon_key % 3 = 0 then 'h' end, 'l') as means from nk)"""
_FILL = """land as (select id, least(count(*), 2) as n, min(p.name) as name from pts join poly p on abs(lon - mx) + abs(lat - my) < r group by 1),
sea as (select id, least(count(*), 2) as n, min(p.name) as name from pts join areas p on abs(lon - mx) + abs(lat - my) < r group by 1)"""
_FILLED = "case when land.n = 1 then land.name end as place, case when coalesce(land.n, 0) <> 1 and sea.n = 1 then sea.name end as region, cast(case when land.n = 1 then 1 else coalesce(sea.n, 0) end as int) as match_count"


def _looked_up(spark: SparkSession, raw: DataFrame, df: DataFrame) -> DataFrame:
    """``df`` (id, provided_name, taxon_key, kingdom) with clean_name, tsn, means, and the kingdom of its taxon; without a name left out."""
    numbers = spark.range(20).select(F.col("id").alias("k"), F.concat(F.lit("Clean "), F.col("id").cast("string")).alias("clean_name"))
    by_name = raw.where("id % 4 = 0 and provided_name is not null").select(F.col("provided_name").alias("k"), F.lit("By name").alias("clean_name")).distinct()
    named = records.fallback_lookup(df, [(by_name, "provided_name", "k"), (numbers, "taxon_key", "k")], "clean_name").where("clean_name is not null")
    tsn = F.concat(F.lit("T"), F.col("k").cast("string"))
    itis = numbers.where("k % 3 = 0").select("clean_name", tsn.alias("tsn"), F.lit("Plantae").alias("kingdom"))
    filled = records.fill(named, itis, "clean_name", ["tsn", "kingdom"])
    rows = numbers.select(F.col("k").alias("line"), F.when(F.col("k") % 2 == 0, tsn).otherwise("").alias("tsn"), F.col("clean_name").alias("name"), F.when(F.col("k") % 2 == 0, "a").otherwise("").alias("ak"), F.when(F.col("k") % 3 == 0, "h").alias("hi"), F.lit("l").alias("l48"))
    means = records.estimated_means(rows)
    return records.fallback_lookup(filled, [(means, "tsn", "key"), (means, "clean_name", "key")], "means")


def _land_and_sea(spark: SparkSession, d: str, df: DataFrame) -> DataFrame:
    return spatial.land_then_sea(df, layer(spark, d, "poly"), layer(spark, d, "areas"))


@Q.add("job_clean_gbif", f"""> {_LOOKUPS}, sets as ({_SETS}),
c as (select *, try_cast({_LON} as double) as x, try_cast({_LAT} as double) as y, case when lower(replace(trim(provider), '$', '')) in ('na', '#na', 'n/a', '') then null else replace(trim(provider), '$', '') end as p from raw
 where not (provided_name is null and taxon_key is null) and not coalesce(lower(status) = 'absent', false)),
p1 as (select id, p as provider, case when x = 0 and y = 0 then null when country in ('US', 'CA') and x > 0 then -x else x end as lon, case when x = 0 and y = 0 then null else y end as lat,
 case basis when 'HUMAN_OBSERVATION' then 'observation' when 'PRESERVED_SPECIMEN' then 'specimen' when 'FOSSIL_SPECIMEN' then 'fossil' else basis end as basis_of_record,
 coalesce(nullif(verbatim_locality, ''), nullif(locality, ''), nullif(habitat, '')) as locality, resource_id, provided_name, taxon_key, kingdom, fips, country, lang, centroid from c),
p2 as (select p1.*, case org_id when 'org-own' then 'Own' when 'org-other' then 'Other' end as organisation from p1 left join sets on resource_id = dataset_id where not coalesce(org_id = 'org-own' and starts_with(sets.resource_url, 'https://own/src1'), false)),
p3 as (select p2.*, coalesce(nn.clean, nk.clean) as clean_name from p2 left join nn using (provided_name) left join nk using (taxon_key) where coalesce(nn.clean, nk.clean) is not null),
p4 as (select p3.* exclude (kingdom), it.tsn, case when it.tsn is not null then 'Plantae' else kingdom end as kingdom from p3 left join it using (clean_name)),
p5 as (select p4.*, coalesce(a.means, b.means) as means from p4 left join em a on a.key = p4.tsn left join em b on b.key = p4.clean_name),
cn(x, y, fips, place) as (values (0.3::double, 0.1::double, '12345', 'US;en'), (-10.3, 9.9, null, 'CA;de')),
j as (select p5.* exclude (lon, lat, centroid), case when coalesce(centroid, '') <> 'county' then lon end as lon, case when coalesce(centroid, '') <> 'county' then lat end as lat, case when coalesce(centroid, '') <> 'county' then centroid end as centroid, coalesce(a.x, b.x) as x, coalesce(a.y, b.y) as y
 from p5 left join cn a on a.fips = p5.fips left join cn b on b.place = p5.country || ';' || p5.lang),
pts as (select j.* exclude (lon, lat, centroid), case when (lon is null or lat is null) and x is not null then x else lon end as lon, case when (lon is null or lat is null) and x is not null then y else lat end as lat, case when (lon is null or lat is null) and x is not null then 'county' else centroid end as centroid from j),
{_FILL}
select pts.id, provider, organisation, lon as longitude, lat as latitude, centroid, basis_of_record, locality, clean_name, tsn, kingdom, means, {_FILLED} from pts left join land using (id) left join sea using (id)""", "raw", "poly", "areas")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Four passes: fields and publishers; names; taxa, means and centroids; land and sea."""
    raw = domain(spark, d, "raw").withColumns({"lon": F.expr(_LON), "lat": F.expr(_LAT)})
    kept = records.discard(raw, "provided_name", "taxon_key", "status")
    lon, lat = X.fixed_point(F.col("lon"), F.col("lat"), F.col("country"))
    cleaned = kept.select("id", X.clean_value(F.col("provider")).alias("provider"), lon.alias("lon"), lat.alias("lat"), X.vocabulary(F.col("basis"), X.BASIS).alias("basis_of_record"), X.second_choice(F.col("verbatim_locality"), F.col("locality"), F.col("habitat")).alias("locality"), F.col("resource_id").alias("dataset_id"), "provided_name", "taxon_key", "kingdom", "fips", "country", "lang", "centroid")
    orgs = spark.createDataFrame([("org-own", "Own"), ("org-other", "Other")], "org_id string, organisation string")
    published = records.provider_resource(cleaned, view(spark, d, _SETS), orgs, "org-own", "https://own/src1")
    taxa = _looked_up(spark, raw, published)
    centroids = spark.createDataFrame([(1, "12345", "US", "en", "POINT (0.3 0.1)"), (2, None, "CA", "de", "POINT (-10.3 9.9)")], "line int, fips string, state string, county string, wkt string")
    placed = records.centroid_lookup(taxa.withColumns({"state": F.col("country"), "county": F.col("lang")}), centroids, "id")
    filled = _land_and_sea(spark, d, placed)
    target = ["id", "provider", "organisation", "longitude", "latitude", "centroid", "basis_of_record", "locality", "clean_name", "tsn", "kingdom", "means", "place", "region", "match_count"]
    return records.rename(filled, {**{c: c for c in target if c not in ("longitude", "latitude")}, "lon": "longitude", "lat": "latitude"}, target)


@Q.add("job_clean_provider", f"""> {_LOOKUPS}, t as (select distinct lang as dataset, 'rename' as action, 'ticket-' || lang as ticket_id from raw where lang in ('en', 'xx')),
e as (select lang as dataset, id as line, case when len(string_split(resource_url, '=')) = 2 and string_split(resource_url, '=')[1] = '{_PREFIX}' then string_split(resource_url, '=')[2] end as rid from raw),
o as (select dataset, arg_min(rid, line) filter (where rid is not null) as rid from e group by 1),
act as (select coalesce(t.dataset, o.dataset) as dataset, coalesce(action, 'rewrite') as action, coalesce(ticket_id, rid, 'legacy-' || o.dataset) as new_id from t full join o on t.dataset = o.dataset),
w as (select id, new_id as resource_id, '{_PREFIX}=' || new_id as resource_url, case when action = 'rename' then 'Name of ' || dataset else coalesce(nullif(regexp_replace(provider, '["$]', '', 'g'), ''), 'Name of ' || dataset) end as resource,
 provided_name, taxon_key, case when lower(kingdom) in ('animalia', 'plantae', 'fungi') then upper(substring(kingdom, 1, 1)) || lower(substring(kingdom, 2)) end as kingdom, try_cast({_LON} as double) as lon, try_cast({_LAT} as double) as lat from raw join act on lang = dataset),
p3 as (select w.*, coalesce(nn.clean, nk.clean) as clean_name from w left join nn using (provided_name) left join nk using (taxon_key) where coalesce(nn.clean, nk.clean) is not null),
p4 as (select p3.* exclude (kingdom), it.tsn, case when it.tsn is not null then 'Plantae' else kingdom end as kingdom from p3 left join it using (clean_name)),
pts as (select p4.*, coalesce(a.means, b.means) as means from p4 left join em a on a.key = p4.tsn left join em b on b.key = p4.clean_name), {_FILL}
select pts.id, resource_id, resource_url, resource, clean_name, tsn, kingdom, means, {_FILLED} from pts left join land using (id) left join sea using (id)""", "raw", "poly", "areas")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Actions built from tickets and the records' own urls; resources rewritten by them; taxa looked up; land and sea."""
    raw = domain(spark, d, "raw")
    sets = raw.select(F.col("lang").alias("dataset")).distinct()
    tickets = sets.where("dataset in ('en', 'xx')").select("dataset", F.lit("rename").alias("action"), F.concat(F.lit("ticket-"), "dataset").alias("ticket_id"))
    legacy = sets.select("dataset", F.concat(F.lit("legacy-"), "dataset").alias("legacy_id"))
    actions = records.resource_actions(tickets, raw.select(F.col("lang").alias("dataset"), "resource_url", F.col("id").alias("line")), legacy, _PREFIX)
    actions = actions.select("dataset", "action", F.col("resource_id").alias("new_id"), F.concat(F.lit("Name of "), "dataset").alias("new_name"))
    rows = raw.select("id", "resource_id", F.col("provider").alias("resource"), "resource_url", "kingdom", "provided_name", "taxon_key", F.col("lang").alias("dataset"))
    done = records.rewrite_resource(records.all_strings(rows, X.without_quotes), actions, "dataset", _PREFIX).withColumn("kingdom", X.kingdom(F.col("kingdom")))
    points = raw.select("id", F.expr(_LON).try_cast("double").alias("lon"), F.expr(_LAT).try_cast("double").alias("lat"))
    filled = _land_and_sea(spark, d, _looked_up(spark, raw, done).join(points, "id"))
    return filled.select("id", "resource_id", "resource_url", "resource", "clean_name", "tsn", "kingdom", "means", "place", "region", "match_count")


# --- matrices ---------------------------------------------------------------------------


@Q.add("job_county_pam", """> h as (select p.name as site, species, count(*) as n from occ join poly p on abs(lon - mx) + abs(lat - my) < r where species is not null group by 1, 2), b as (select site, species from h where n >= 2),
al as (select site, count(*) as alpha from b group by 1), om as (select species, count(*) as omega from b group by 1), z as (select count(distinct species) as s, count(distinct site) as n from b),
st as (select site, count(*) as alpha, sum(omega)::bigint as phi from b join om using (species) group by 1), sp as (select species, count(*) as omega, sum(alpha)::bigint as psi from b join al using (site) group by 1)
select 'site' as axis, name as label, round(mx, 6) as x, round(my, 6) as y, coalesce(alpha, 0) as count, phi as total, round(alpha / z.s, 9) as proportional, round(phi / (z.n * alpha), 9) as average_proportional from poly left join st on st.site = name, z union all
select 'species', species, null, null, omega, psi, round(omega / z.n, 9), round(psi / (z.s * omega), 9) from sp, z union all
select 'all', 'whittaker', null, null, z.s, z.n, round(z.s / (select avg(alpha) from al), 9), round(z.s - (select avg(alpha) from al), 9) from z""", "occ", "poly")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Sites from the county index, presence from counts, and the statistics of sites (absent ones with 0), species and the whole."""
    poly = layer(spark, d, "poly")
    hits = spatial.spatial_join(domain(spark, d, "occ").select("gbifid", "species", "lon", "lat"), poly, "name")
    path = io.scratch(spark, "county-pam")
    io.write_parquet(diversity.presence(matrix.build(hits.withColumn("n", F.lit(1).cast("long")), "name", "species", "n"), 2), path)
    pam = spark.read.parquet(path)
    none = F.lit(None).cast("double")
    site = diversity.site_stats(pam).select("site", F.col("alpha").alias("count"), F.col("phi").alias("total"), F.col("alpha_proportional").alias("proportional"), F.col("phi_average_proportional").alias("average_proportional"))
    index = spatial.site_index(poly, "name").select("site", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))
    sites = spatial.with_absent(index, site, "count").select(F.lit("site").alias("axis"), F.col("site").alias("label"), "x", "y", "count", "total", "proportional", "average_proportional")
    species = diversity.species_stats(pam).select(F.lit("species").alias("axis"), F.col("species").alias("label"), none.alias("x"), none.alias("y"), F.col("omega").alias("count"), F.col("psi").alias("total"), F.col("omega_proportional").alias("proportional"), F.col("psi_average_proportional").alias("average_proportional"))
    whole = diversity.diversity_stats(pam).select(F.lit("all").alias("axis"), F.lit("whittaker").alias("label"), none.alias("x"), none.alias("y"), F.col("S").alias("count"), F.col("N").alias("total"), F.col("whittaker").alias("proportional"), F.col("lande").alias("average_proportional"))
    out = sites.unionByName(species).unionByName(whole)
    return out.withColumns({c: F.round(c, 9) for c in ("proportional", "average_proportional")})
