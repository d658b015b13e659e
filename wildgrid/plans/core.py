"""Queries: scans, sinks, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from wildgrid.functions import text as X
from wildgrid.operators import records, spatial
from wildgrid.sources import io
from wildgrid.streaming import arrivals

from .query import Queries
from .views import annotated_table, domain, layer

Q = Queries()


def put(df, name, write):
    """A path that ``write(df, path)`` has filled."""
    path = io.scratch(df.sparkSession, name)
    write(df, path)
    return path


# --- scans --------------------------------------------------------------------


@Q.add("scan_occurrence_parquet", "select gbifid::varchar as gbifid, datasetkey, species, taxonrank, countrycode, occurrencestatus, taxonkey, basisofrecord, lon as decimallongitude, lat as decimallatitude, [species] as recordedby from occ", "occ")
def _(spark, d):
    occ = domain(spark, d, "occ").withColumn("gbifid", F.col("gbifid").cast("string")).withColumnsRenamed({"lon": "decimallongitude", "lat": "decimallatitude"})
    path = put(occ.withColumn("recordedby", F.array(F.struct(F.col("species").alias("array_element")))), "occurrence", lambda x, p: x.write.parquet(p))
    return io.occurrences(spark, path).select("gbifid", "datasetkey", "species", "taxonrank", "countrycode", "occurrencestatus", "taxonkey", "basisofrecord", "decimallongitude", "decimallatitude", "recordedby")


@Q.add("scan_parquet_folder", "select o_orderkey, o_custkey, o_totalprice from orders")
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = put(o, "folder", lambda x, p: x.write.partitionBy("o_orderstatus").parquet(p))
    return io.parquet_folder(spark, path)


@Q.add("scan_parquet_file", "select * from customer")
def _(spark, d):
    return spark.read.parquet(f"{d}/customer.parquet")


@Q.add("scan_csv", "select p_partkey, p_name, p_size from part")
def _(spark, d):
    path = put(spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_name", "p_size"), "csv", lambda x, p: x.write.option("header", True).csv(p, sep="|"))
    return io.csv(spark, path, "p_partkey long, p_name string, p_size int", sep="|")


@Q.add("scan_csv_dict", "select p_partkey, p_type, p_partkey % 5 = 0 as surplus from part")
def _(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet")
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_type", F.when(F.col("p_partkey") % 5 == 0, "more"))
    path = put(p.select(line.alias("value")), "dict", lambda x, p: x.write.text(p))
    found = io.csv(spark, path, "p_partkey long, p_type string", sep="\t", quoted=False, header=False, rest="rest")
    return found.select("p_partkey", "p_type", F.col("rest").isNotNull().alias("surplus"))


@Q.add("scan_riis", "select locality, gbif_res_taxonkey, occurrenceid::varchar as occurrenceid, degreeofestablishment from riis", "riis")
def _(spark, d):
    r = domain(spark, d, "riis")
    path = put(r, "register", lambda x, p: x.write.option("header", True).csv(p))
    return io.register_csv(spark, path, r.columns)


@Q.add("scan_polygons", "select fid, name, stusps, 4::bigint as n_edges from poly", "poly")
def _(spark, d):
    rings = F.array(F.transform("edges", lambda e: F.struct(e["x1"].alias("x"), e["y1"].alias("y"))))
    path = put(layer(spark, d, "poly").withColumn("rings", rings).drop("edges"), "layer", lambda x, p: x.write.parquet(p))
    from wildgrid.functions.geometry import edges

    return io.polygons(spark, path).select("fid", "name", "stusps", F.size(edges(F.col("rings"))).cast("long").alias("n_edges"))


@Q.add("scan_dwca_tab", "select gbifid::varchar as gbifid, taxonkey::varchar as taxonkey, taxonrank from occ", "occ")
def _(spark, d):
    o = domain(spark, d, "occ").select("gbifid", "taxonkey", "taxonrank")
    path = put(o, "dwca", lambda x, p: x.write.option("header", True).csv(p, sep="\t"))
    return io.darwin_core(spark, path, o.columns)


@Q.add("lookup_load_priority_key", """> k as (select coalesce(nullif(trim(provider), ''), nullif(trim(provided_name), '')) as lookup_key, id, lang from raw)
select lookup_key, max(id) as id, arg_max(lang, id) as lang from k where lookup_key is not null group by 1""", "raw")
def _(spark, d):
    return records.priority_key(domain(spark, d, "raw").select("id", "provider", "provided_name", "lang"), ["provider", "provided_name"], "id").select("lookup_key", "id", "lang")


@Q.add("find_record_by_id", "select * from occ where gbifid = 7", "occ")
def _(spark, d):
    return io.by_id(domain(spark, d, "occ"), "gbifid", 7)


# --- sinks: written and read again ----------------------------------------------

_BY_STATE = "select census_state, count(*) as occ_count from ann where census_state is not null group by 1"


def _by_state(spark, d):
    return annotated_table(spark, d).where("census_state is not null").groupBy("census_state").agg(F.count("*").alias("occ_count"))


@Q.add("sink_parquet_sorted", _BY_STATE, "ann")
def _(spark, d):
    return spark.read.parquet(put(_by_state(spark, d), "sorted", lambda x, p: io.write_sorted(x, p, "census_state")))


@Q.add("sink_csv_header", _BY_STATE, "ann")
def _(spark, d):
    return io.csv(spark, put(_by_state(spark, d), "header", lambda x, p: io.write_sorted(x, p, "census_state", kind="csv")), "census_state string, occ_count long")


@Q.add("sink_annotated_records", "select gbifid, census_state, riis_assessment from ann where census_state is not null", "ann")
def _(spark, d):
    path = put(annotated_table(spark, d).select("gbifid", "census_state", "riis_assessment", F.struct("lon", "lat").alias("geom")), "annotated", io.write_annotated)
    return io.csv(spark, f"{path}/text", "gbifid long, census_state string, riis_assessment string", sep="\t").intersect(spark.read.parquet(f"{path}/parquet"))


@Q.add("sink_partitioned", "select gbifid, species, census_state from ann where census_state is not null", "ann")
def _(spark, d):
    kept = annotated_table(spark, d).where("census_state is not null").select("gbifid", "species", "census_state")
    return spark.read.parquet(put(kept, "partitioned", lambda x, p: io.write_by(x, p, "census_state")))


@Q.add("split_by_value", "select gbifid, lon, lat, taxonrank from occ", "occ")
def _(spark, d):
    path = put(domain(spark, d, "occ"), "split", lambda x, p: io.write_by(x, p, "taxonrank", columns=["gbifid", "lon", "lat"], kind="csv"))
    return io.csv(spark, path, "gbifid long, lon double, lat double").withColumn("taxonrank", F.regexp_extract(F.input_file_name(), "taxonrank=([^/]*)", 1))


_CHUNKS = "> o as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as k, (select cast(ceil(count(*) / 10.0) as bigint) from orders) as n from orders) select cast(k // n as int) as chunk, min(k)::bigint as start, max(k)::bigint as stop from o group by 1"


@Q.add("chunk_assign", "with " + _CHUNKS.removeprefix("> "))
def _(spark, d):
    rows = spatial.chunk_bounds(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey"), 10, "o_orderkey")
    return rows.groupBy("chunk").agg(F.min("rank").alias("start"), F.max("rank").alias("stop"))


@Q.add("sink_ctas", "select c_custkey, c_name from customer where c_acctbal > 0")
def _(spark, d):
    """A table of the warehouse is created from a query, read by its name, delivered as Parquet, and dropped."""
    import uuid

    name = f"ctas_{uuid.uuid4().hex}"
    found = io.write_table(spark.read.parquet(f"{d}/customer.parquet").where("c_acctbal > 0").select("c_custkey", "c_name"), name)
    try:
        return spark.read.parquet(put(found, "ctas", io.write_parquet))
    finally:
        io.drop_table(spark, name)


@Q.add("sink_subset_snappy", "select gbifid, taxonkey, lon, lat from sub", "sub")
def _(spark, d):
    return spark.read.parquet(put(records.subset(domain(spark, d, "occ")).select("gbifid", "taxonkey", "lon", "lat"), "snappy", io.write_parquet))


@Q.add("sample_ctas", "select o_orderkey, o_custkey from orders order by o_orderkey limit 10000 offset 0")
def _(spark, d):
    first = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_custkey").orderBy("o_orderkey").offset(0).limit(10000)
    return spark.read.parquet(put(first, "sample", io.write_parquet))


@Q.add("sink_parquet_df", "select * from supplier")
def _(spark, d):
    return spark.read.parquet(put(spark.read.parquet(f"{d}/supplier.parquet"), "df", io.write_parquet))


@Q.add("sink_csv_dict", "select s_name, s_suppkey from supplier")
def _(spark, d):
    path = put(spark.read.parquet(f"{d}/supplier.parquet"), "dict", lambda x, p: io.write_csv(x, p, ["s_name", "s_suppkey"]))
    return io.csv(spark, path, "s_name string, s_suppkey long")


@Q.add("stream_csv_to_parquet", "select event_id, user_id, event_type, value from events")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", "value")
    source = put(e, "arrivals", lambda x, p: x.write.option("header", True).csv(p))
    target = io.scratch(spark, "arrived")
    arrivals.csv_to_parquet(spark, source, f"{target}/out", f"{target}/checkpoint", "event_id long, user_id long, event_type string, value double")
    return spark.read.parquet(f"{target}/out")


# --- filters and projections ----------------------------------------------------


@Q.add("subset_filter", "select gbifid, taxonkey, lon, lat from sub", "sub")
def _(spark, d):
    return records.subset(domain(spark, d, "occ")).select("gbifid", "taxonkey", "lon", "lat")


_WIDE = "gbifid, datasetkey, publishingorgkey, taxonkey, species, taxonrank, countrycode, occurrencestatus, basisofrecord, lon, lat"


@Q.add("subset_project", f"select {_WIDE}, cast(taxonkey as string) || ' ' || species as taxonkey_species from sub", "sub")
def _(spark, d):
    return records.subset_columns(records.subset(domain(spark, d, "occ"))).drop("geom")


@Q.add("make_point", "select gbifid, lon is not null and lat is not null as placed, case when lon is not null and lat is not null then lon end as x, case when lon is not null and lat is not null then lat end as y from occ", "occ")
def _(spark, d):
    p = records.subset_columns(domain(spark, d, "occ"))
    return p.select("gbifid", F.col("geom").isNotNull().alias("placed"), F.col("geom.lon").alias("x"), F.col("geom.lat").alias("y"))


@Q.add("unique_species_key", "select gbifid, cast(taxonkey as string) || ' ' || species as taxonkey_species from occ", "occ")
def _(spark, d):
    return domain(spark, d, "occ").select("gbifid", X.species_key(F.col("taxonkey"), F.col("species")).alias("taxonkey_species"))


@Q.add("state_county_key", "select fid, stusps || ' ' || name as state_county, stusps || '_' || name as old_key from poly", "poly")
def _(spark, d):
    return domain(spark, d, "poly").select("fid", X.place_key(F.col("stusps"), F.col("name")).alias("state_county"), X.place_key(F.col("stusps"), F.col("name"), "_").alias("old_key"))


@Q.add("compound_key", """> k as (select id, nullif(array_to_string(list_filter([case when id % 2 = 0 then 'na' else lang end, case when id % 3 = 0 then 'na' else country end], lambda p: p <> 'na'), '__'), '') as key from raw)
select id, key, array_to_string(string_split(key, '__'), '/') as parts from k""", "raw")
def _(spark, d):
    key = X.compound_key(F.when(F.col("id") % 2 == 0, "na").otherwise(F.col("lang")), F.when(F.col("id") % 3 == 0, "na").otherwise(F.col("country")))
    return domain(spark, d, "raw").select("id", key.alias("key")).withColumn("parts", F.array_join(X.key_parts(F.col("key")), "/"))


@Q.add("add_null_columns", "select gbifid, cast(null as varchar) as census_state, cast(null as varchar) as riis_region from occ", "occ")
def _(spark, d):
    return records.add_null_columns(domain(spark, d, "occ").select("gbifid"), "census_state", "riis_region")


_RANKED = "select gbifid, taxonrank as rank, taxonkey as accepted_key, case when taxonkey % 3 = 0 then taxonkey + 1000 else taxonkey end as species_key from occ"


def _ranked(spark, d):
    k = F.col("taxonkey")
    return domain(spark, d, "occ").select("gbifid", F.col("taxonrank").alias("rank"), k.alias("accepted_key"), F.when(k % 3 == 0, k + 1000).otherwise(k).alias("species_key"))


@Q.add("rank_filter_taxkeys", f"""> t as ({_RANKED}) select gbifid, cast(accepted_key as string) || case when lower(rank) <> 'species' and accepted_key <> species_key then ',' || cast(species_key as string) else '' end as keys
from t where lower(rank) in ('species', 'subspecies', 'variety', 'form', 'infraspecific_name', 'infrasubspecific_name')""", "occ")
def _(spark, d):
    return records.taxon_keys(_ranked(spark, d)).select("gbifid", F.array_join(F.transform("keys", lambda k: k.cast("string")), ",").alias("keys"))


@Q.add("field_map_rename", "select id, provided_name as provided_scientific_name, lon as longitude, cast(null as varchar) as hierarchy_string from raw", "raw")
def _(spark, d):
    return records.rename(domain(spark, d, "raw"), {"id": "id", "provided_name": "provided_scientific_name", "lon": "longitude", "text": "temporary"}, ["id", "provided_scientific_name", "longitude", "hierarchy_string"])


@Q.add("clean_value", "select id, case when lower(replace(trim(provider), '$', '')) in ('na', '#na', 'n/a', '') then null else replace(trim(provider), '$', '') end as provider from raw", "raw")
def _(spark, d):
    return domain(spark, d, "raw").select("id", X.clean_value(F.col("provider")).alias("provider"))


@Q.add("type_limit", "select id, try_cast(year as int) as year, try_cast(lon as double) as lon, substring(resource_url, 1, 20) as resource_url from raw", "raw")
def _(spark, d):
    return records.limit_fields(domain(spark, d, "raw").select("id", "year", "lon", "resource_url"), {"year": ("integer", None), "lon": ("double", None), "resource_url": ("varchar", 20)})


@Q.add("discard_invalid", "select id from raw where not (provided_name is null and taxon_key is null) and not coalesce(lower(status) = 'absent', false)", "raw")
def _(spark, d):
    return records.discard(domain(spark, d, "raw"), "provided_name", "taxon_key", "status").select("id")


@Q.add("control_vocabulary", "select id, case basis when 'HUMAN_OBSERVATION' then 'observation' when 'PRESERVED_SPECIMEN' then 'specimen' when 'FOSSIL_SPECIMEN' then 'fossil' else basis end as basis from raw", "raw")
def _(spark, d):
    return domain(spark, d, "raw").select("id", X.vocabulary(F.col("basis"), X.BASIS).alias("basis"))


@Q.add("second_choice", "select id, coalesce(nullif(verbatim_locality, ''), nullif(locality, ''), nullif(habitat, '')) as locality from raw", "raw")
def _(spark, d):
    return domain(spark, d, "raw").select("id", X.second_choice(F.col("verbatim_locality"), F.col("locality"), F.col("habitat")).alias("locality"))


@Q.add("fix_dates", """> p as (select id, occurrence_date as o, string_split(occurrence_date, 'T')[1] as t, year from raw), q as (select *, regexp_matches(t, '^[0-9]+(-[0-9]+)*$') as ok from p)
select id, case when ok then t else o end as occurrence_date, coalesce(try_cast(year as int), case when ok then try_cast(string_split(t, '-')[1] as int) end) as year from q""", "raw")
def _(spark, d):
    date, year = X.fixed_date(F.col("occurrence_date"), F.col("year"))
    return domain(spark, d, "raw").select("id", date.alias("occurrence_date"), year.alias("year"))


@Q.add("clip_date", "select id, string_split(occurrence_date, 'T')[1] as clipped from raw", "raw")
def _(spark, d):
    return domain(spark, d, "raw").select("id", X.date_part(F.col("occurrence_date")).alias("clipped"))


@Q.add("first_newer", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') >= '1995-06-17' as newer from orders")
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select("o_orderkey", X.first_newer(F.date_format("o_orderdate", "yyyy-M-d'T'HH:mm"), F.lit("1995-6-17")).alias("newer"))


@Q.add("fix_point", """> p as (select id, try_cast(lon as double) as x, try_cast(lat as double) as y, country from raw)
select id, case when x = 0 and y = 0 then null when country in ('US', 'CA') and x > 0 then -x else x end as lon, case when x = 0 and y = 0 then null else y end as lat from p""", "raw")
def _(spark, d):
    lon, lat = X.fixed_point(F.col("lon"), F.col("lat"), F.col("country"))
    return domain(spark, d, "raw").select("id", lon.alias("lon"), lat.alias("lat"))


@Q.add("numeric_coords", "select id, case when try_cast(lat as double) is not null then try_cast(lon as double) end as lon, case when try_cast(lon as double) is not null then try_cast(lat as double) end as lat from raw", "raw")
def _(spark, d):
    lon, lat = X.both_or_none(F.col("lon"), F.col("lat"))
    return domain(spark, d, "raw").select("id", lon.alias("lon"), lat.alias("lat"))


@Q.add("clean_kingdom", "select id, case when lower(kingdom) in ('animalia', 'plantae', 'bacteria', 'fungi', 'protozoa', 'chromista', 'archaea', 'virus') then upper(substring(kingdom, 1, 1)) || lower(substring(kingdom, 2)) end as kingdom from raw", "raw")
def _(spark, d):
    return domain(spark, d, "raw").select("id", X.kingdom(F.col("kingdom")).alias("kingdom"))


@Q.add("strip_quotes_delims", "select id, replace(regexp_replace(provider, '^\"+|\"+$', '', 'g'), '$', '') as provider, replace(regexp_replace(lang, '^\"+|\"+$', '', 'g'), '$', '') as lang from raw", "raw")
def _(spark, d):
    return records.all_strings(domain(spark, d, "raw").select("id", "provider", "lang"), X.without_quotes)


@Q.add("ascii_only", "select id, regexp_replace(text, '[^\\x00-\\x7F]', '', 'g') as text from raw", "raw")
def _(spark, d):
    return domain(spark, d, "raw").select("id", X.ascii_only(F.col("text")).alias("text"))


@Q.add("standardize_name", "select id, trim(coalesce(provided_name, '') || ' ' || coalesce(accepted_name, '')) as name from raw", "raw")
def _(spark, d):
    return domain(spark, d, "raw").select("id", X.full_name(F.col("provided_name"), F.col("accepted_name")).alias("name"))


@Q.add("provider_constants", "select id, 'P1' as provider_id, case when starts_with(resource_url, 'https://host') then resource_url else 'https://host' end as resource_url from raw", "raw")
def _(spark, d):
    return records.provider_constants(domain(spark, d, "raw").select("id", "resource_url"), {"provider_id": "P1"}, "resource_url", "https://host").select("id", "provider_id", "resource_url")


_PREFIX = "https://host/ipt/resource?r"
_ACTIONS = "select distinct source as resource_id, case length(source) % 3 when 0 then 'rename' when 1 then 'rewrite' else 'replace' end as action, 'new-' || source as new_id, 'Name ' || source as new_name from documents where source <> 'src0'"


@Q.add("resource_rewrite", f"""> a as ({_ACTIONS}) select id, coalesce(new_id, r.resource_id) as resource_id,
case when action = 'rename' then new_name when action is not null then coalesce(nullif(provider, ''), new_name) else provider end as resource, coalesce('{_PREFIX}=' || new_id, resource_url) as resource_url from raw r left join a using (resource_id)""", "raw")
def _(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").where("source <> 'src0'").select("source").distinct()
    n = F.length("source") % 3
    actions = docs.select(F.col("source").alias("resource_id"), F.when(n == 0, "rename").when(n == 1, "rewrite").otherwise("replace").alias("action"), F.concat(F.lit("new-"), "source").alias("new_id"), F.concat(F.lit("Name "), "source").alias("new_name"))
    raw = domain(spark, d, "raw").select("id", "resource_id", F.col("provider").alias("resource"), "resource_url")
    return records.rewrite_resource(raw, actions, "resource_id", _PREFIX).select("id", "resource_id", "resource", "resource_url")


@Q.add("parse_resource_url", f"""select id, case when len(string_split(resource_url, '=')) = 2 and string_split(resource_url, '=')[1] = '{_PREFIX}' then string_split(resource_url, '=')[2] end as name,
case when len(string_split(resource_url, '=')) = 2 and string_split(resource_url, '=')[1] = '{_PREFIX}' then '{_PREFIX}=' || string_split(resource_url, '=')[2] end as url from raw""", "raw")
def _(spark, d):
    name, url = X.url_parts(F.col("resource_url"), _PREFIX)
    return domain(spark, d, "raw").select("id", name.alias("name"), url.alias("url"))


_COUNTY = """select n_nationkey as id, case when n_nationkey % 2 = 0 then n_name end as state_name, n_name || ' Canada' as prname, case when n_nationkey % 3 = 0 then 'C' || n_name end as name, 'D' || n_name as cdname,
case when n_nationkey % 2 = 0 then '01' end as state_fips, '002' as county_fips, cast(n_nationkey as string) as cduid from nation"""


@Q.add("county_value_calc", f"> c as ({_COUNTY}) select id, coalesce(state_name, replace(prname, ' Canada', '')) as b_state, coalesce(name, cdname) as b_county, coalesce(state_fips || county_fips, cduid) as b_fips from c".replace("> c", "with c", 1))
def _(spark, d):
    from .views import view

    return records.county_values(view(spark, d, _COUNTY)).select("id", "b_state", "b_county", "b_fips")


@Q.add("state_fips", "select id, case when length(fips) = 5 and country <> 'CA' then substring(fips, 1, 2) end as state_fips from raw", "raw")
def _(spark, d):
    return domain(spark, d, "raw").select("id", records.state_code(F.col("fips"), F.col("country")).alias("state_fips"))


# --- scalar helpers -------------------------------------------------------------


@Q.add("centroid_wkt", "select fid, mx as x, my as y from poly", "poly")
def _(spark, d):
    wkt = F.concat(F.lit("POINT ("), F.col("mx").cast("string"), F.lit(" "), F.col("my").cast("string"), F.lit(")"))
    x, y = X.centroid(wkt)
    return domain(spark, d, "poly").select("fid", x.alias("x"), y.alias("y"))


@Q.add("month_strings", "select o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y_%m_%d') as this_month, strftime(date_trunc('month', o_orderdate) - interval 1 month, '%Y_%m_%d') as month_before from orders")
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select("o_orderkey", X.month_string(F.col("o_orderdate")).alias("this_month"), X.month_string(F.col("o_orderdate"), 1).alias("month_before"))


# --- databases ------------------------------------------------------------------


def _through_database(spark, d, table, replace):
    """Through a database file in the shared folder; a real database is given by its own url."""
    df = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_acctbal")
    at = io.database(spark, "database")
    if replace:
        io.make_table(df, at, table, replace=True)
    io.fill_database(df, at, table)
    return io.jdbc_parts(spark, io.open_database(spark, at), table, "s_suppkey", **io.DERBY).select("s_suppkey", "s_acctbal")


@Q.add("scan_jdbc", "select s_suppkey, s_acctbal from supplier")
def _(spark, d):
    return _through_database(spark, d, "scanned", False)


@Q.add("sink_jdbc", "select s_suppkey, s_acctbal from supplier")
def _(spark, d):
    return _through_database(spark, d, "appended", True)
