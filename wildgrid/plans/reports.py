"""Queries: counts, lists, summaries, order, sets, data quality, jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from wildgrid.operators import counts, quality, records, register, spatial
from wildgrid.sources import io

from .query import Queries
from .views import annotated_table, domain, view

Q = Queries()


def _read(spark, d, table):
    return spark.read.parquet(f"{d}/{table}.parquet")


# --- counts ---------------------------------------------------------------------


def _counts(name, region, more=()):
    cols = ", ".join([region, *more])

    @Q.add(name, f"select {cols}, count(*) as occ_count, count(distinct taxonkey) as species_count from ann where {region} is not null and species is not null group by {cols}", "ann")
    def _(spark, d):
        return counts.region_counts(annotated_table(spark, d), region, *more)


for _n, (_c, _) in counts.REGIONS.items():
    _counts(f"counts_by_{_n}", _c)
    _counts(f"counts_{_n}_x_riis", _c, ("riis_assessment",))


def _list(name, *keys):
    cols = ", ".join([*keys, "taxonkey_species", "taxonkey", "species", "riis_assessment"])

    @Q.add(name, f"select {cols}, count(*) as occ_count from ann where census_state is not null and species is not null group by {cols}", "ann")
    def _(spark, d):
        return counts.species_list(annotated_table(spark, d), *keys)


_list("list_state_species", "census_state")
_list("list_county_species", "state_county", "census_state", "census_county")
_list("list_aiannh_species", "aiannh_name")


@Q.add("riis_totals", "select riis_assessment, count(*) as total from ann group by 1", "ann")
def _(spark, d):
    return counts.totals(annotated_table(spark, d), "riis_assessment").orderBy("total")


@Q.add("coverage_counts", "select count(*) as total, count(census_state) as with_state, count(riis_occurrence_id) as with_register from ann", "ann")
def _(spark, d):
    return counts.coverage(annotated_table(spark, d))


@Q.add("count_records", "select (select count(*) from orders) as orders, (select count(*) from sub) as kept", "sub")
def _(spark, d):
    occ = domain(spark, d, "occ")
    return _read(spark, d, "orders").agg(F.count("*").alias("orders")).crossJoin(F.broadcast(records.subset(occ).agg(F.count("*").alias("kept"))))


_SUMMARY = """sm as (select location_type, location, concat_ws('__', riis_region, cast(taxonkey as string)) as region_species, species, count(*) as count from (
 select 'state' as location_type, census_state as location, riis_region, taxonkey, species from ann union all
 select 'county', state_county, riis_region, taxonkey, species from ann union all select 'aiannh', aiannh_name, riis_region, taxonkey, species from ann) q
 where location is not null and species is not null group by all)"""


def _summary(spark, d):
    return counts.location_summary(annotated_table(spark, d))


@Q.add("location_summary", f"> {_SUMMARY} select * from sm", "ann")
def _(spark, d):
    return _summary(spark, d)


@Q.add("location_violations", "select 'state' as location_type, count(*) filter (where census_state is null) as n from ann union all select 'county', count(*) filter (where state_county is null) from ann", "ann")
def _(spark, d):
    return counts.location_violations(annotated_table(spark, d))


def _parts(ann):
    return [counts.location_summary(ann.where(F.col("gbifid") % 3 == k)) for k in range(3)]


@Q.add("combine_summaries", f"> {_SUMMARY} select location_type, location, region_species, species, cast(count as bigint) as count from sm", "ann")
def _(spark, d):
    return counts.combine(*_parts(annotated_table(spark, d)))


@Q.add("summary_report", f"> {_SUMMARY} select location_type, location, count(distinct region_species) as species, sum(count)::bigint as occurrences from sm group by 1, 2", "ann")
def _(spark, d):
    return counts.summary_report(_summary(spark, d))


@Q.add("species_for_location", f"> {_SUMMARY} select region_species, species, sum(count)::bigint as count from sm where location_type = 'state' and location = 'AK' group by 1, 2", "ann")
def _(spark, d):
    return counts.species_in(_summary(spark, d), "state", "AK")


@Q.add("locations_for_type", f"> {_SUMMARY} select distinct location from sm where location_type = 'county'", "ann")
def _(spark, d):
    return counts.locations_of(_summary(spark, d), "county")


@Q.add("species_lookup", f"> {_SUMMARY} select region_species, min(species) as species from sm group by 1", "ann")
def _(spark, d):
    return counts.species_lookup(_summary(spark, d))


_AGG = f"""{_SUMMARY}, ra as (select location_type, location, try_cast(string_split(region_species, '__')[2] as int) as key, species, count, coalesce(riis_assessment, 'presumed_native') as assessment
 from sm left join keyed k on k.locality = string_split(region_species, '__')[1] and k.key = try_cast(string_split(region_species, '__')[2] as int))"""


def _aggregate(spark, d):
    return counts.region_aggregate(_summary(spark, d), register.by_taxon(domain(spark, d, "riis")))


@Q.add("region_aggregate", f"> {_AGG} select * from ra", "ann", "keyed")
def _(spark, d):
    return _aggregate(spark, d)


_STATUS = ("ECONOMY", "PROMO", "presumed_native")


def _pivot_sql():
    parts = [f"count(distinct case when assessment = '{s}' then key end) as {s}_species, coalesce(sum(case when assessment = '{s}' then count end), 0)::bigint as {s}_occs" for s in _STATUS]
    share = [f"round({s}_{w}::double / nullif({w}, 0), 3) as pct_{s}_{w}" for s in _STATUS for w in ("species", "occs")]
    return f"> {_AGG}, pv as (select location_type, location, {', '.join(parts)}, count(distinct key) as species, sum(count)::bigint as occs from ra group by 1, 2) select *, {', '.join(share)} from pv"


@Q.add("riis_region_pivot", _pivot_sql(), "ann", "keyed")
def _(spark, d):
    return counts.status_pivot(_aggregate(spark, d), "location_type", "location", statuses=_STATUS)


@Q.add("provider_resource_counts", "select 'provider' as kind, lang as id, count(*) as n from documents group by 2 union all select 'resource', source, count(*) from documents group by 2")
def _(spark, d):
    return counts.provider_counts(_read(spark, d, "documents"), "lang", "source")


@Q.add("provider_mismatch", "with l as (select source, min(lang) as lang from documents group by 1) select doc_id, documents.lang, l.lang as expected from documents join l using (source) where documents.lang is distinct from l.lang")
def _(spark, d):
    docs = _read(spark, d, "documents").select("doc_id", "source", "lang")
    lookup = docs.groupBy("source").agg(F.min("lang").alias("lang"))
    return counts.mismatches(docs, lookup, "source", "lang").select("doc_id", "lang", "expected")


@Q.add("name_taxkey_sets", "select p_name as name, string_agg(distinct cast(p_size as string), ',' order by cast(p_size as string)) as keys from part where p_name is not null group by 1")
def _(spark, d):
    part = _read(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("key"))
    return counts.key_sets(part, "name", "key").select("name", F.array_join("keys", ",").alias("keys"))


@Q.add("group_value_counts", "select l_returnflag, count(*) as n from lineitem group by 1")
def _(spark, d):
    return counts.value_counts(_read(spark, d, "lineitem"), "l_returnflag")


@Q.add("distinct_sort_values", "select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def _(spark, d):
    return _read(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@Q.add("count_assessments", "> v(riis_assessment) as (values ('ECONOMY'), ('presumed_native'), ('never seen')) select v.riis_assessment, count(gbifid) as n from v left join ann using (riis_assessment) group by 1", "ann")
def _(spark, d):
    return counts.assessment_counts(annotated_table(spark, d), ("ECONOMY", "presumed_native", "never seen"))


@Q.add("count_locations_species", f"> {_SUMMARY} select 'location' as kind, location_type || '__' || location as label, sum(count)::bigint as count from sm group by 2 union all select 'species', region_species, sum(count)::bigint from sm group by 2", "ann")
def _(spark, d):
    return counts.location_species_counts(_summary(spark, d))


@Q.add("compare_location_counts", f"> {_SUMMARY} select distinct location_type, location, case when location = 'AK' then 'missing' when location = 'HI' then 'unequal' else 'good' end as verdict from sm", "ann")
def _(spark, d):
    """Parts against a whole from which AK was taken, and HI counted once too much."""
    ann = annotated_table(spark, d)
    whole = counts.location_summary(ann).where("location <> 'AK'")
    odd = F.when(F.col("location") == "HI", F.col("count") + 1).otherwise(F.col("count"))
    return counts.compare_counts(counts.combine(*_parts(ann)), whole.withColumn("count", odd))


@Q.add("annotate_report", "select 'failed_id' as what, cast(gbifid as string) as value, 1::bigint as n from sub where gbifid in (select gbifid from ann where census_state is null) union all select 'rank', taxonrank, count(*) from occ where taxonrank not in ('SPECIES', 'SUBSPECIES', 'VARIETY', 'FORM', 'INFRASPECIFIC_NAME', 'INFRASUBSPECIFIC_NAME') group by 2", "ann")
def _(spark, d):
    occ = domain(spark, d, "occ")
    rejected = records.rejected_ranks(occ.select(F.col("taxonrank").alias("rank")))
    return counts.annotate_report(records.subset(occ), annotated_table(spark, d).where("census_state is not null"), "gbifid", rejected)


# --- order and sets ---------------------------------------------------------------


@Q.add("sorted_run_id", """with l as (select event_type, event_id, user_id, lag(user_id) over (partition by event_type order by event_id) as before from events)
select event_type, event_id, user_id, cast(sum(case when user_id < before then 1 else 0 end) over (partition by event_type order by event_id rows unbounded preceding) as int) as run from l""")
def _(spark, d):
    return records.sorted_runs(_read(spark, d, "events").select("event_type", "event_id", "user_id"), "user_id", "event_id", "event_type")


@Q.add("order_limit_checks", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def _(spark, d):
    return _read(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


def _in_order(spark, df, name):
    """Written in its order, and read again with each row's place in the files."""
    path = io.scratch(spark, name)
    io.write_parquet(df, path)
    return io.positions(spark, path)


@Q.add("merge_sorted", "select event_id, user_id, row_number() over (order by event_id) - 1 as position from events")
def _(spark, d):
    """Three tables, each sorted, merged to one whose files follow one another in order."""
    e = _read(spark, d, "events").select("event_id", "user_id")
    return _in_order(spark, records.merge_sorted("event_id", *[e.where(F.col("event_id") % 3 == k).sort("event_id") for k in range(3)]), "merged")


@Q.add("sort_by_columns", "select c_custkey, c_nationkey, c_acctbal, row_number() over (order by c_nationkey, c_acctbal, c_custkey) - 1 as position from customer")
def _(spark, d):
    return _in_order(spark, _read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal").orderBy("c_nationkey", "c_acctbal", "c_custkey"), "by-columns")


@Q.add("union_all", "select s_name as name, s_acctbal as bal from supplier union all select c_name, c_acctbal from customer")
def _(spark, d):
    s, c = _read(spark, d, "supplier"), _read(spark, d, "customer")
    return s.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal")).unionByName(c.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal")))


@Q.add("except_ids", "select distinct c_custkey as id from customer except select o_custkey from orders where o_orderstatus = 'P'")
def _(spark, d):
    c = _read(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return c.join(_read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id")), "id", "left_anti").distinct()


@Q.add("union_distinct_ids", "select c_nationkey as id from customer union select s_nationkey from supplier")
def _(spark, d):
    return _read(spark, d, "customer").select(F.col("c_nationkey").alias("id")).union(_read(spark, d, "supplier").select("s_nationkey")).distinct()


_VERSIONS = "select concat(p_brand, '_2024_01_01') as name from part where p_size % 2 = 0 union all select concat(p_brand, '_2024_02_01') as name from part where p_size % 3 = 0"


@Q.add("intersect_versions", f"""with v as ({_VERSIONS}) select distinct regexp_replace(name, '_2024_01_01$', '') as stem from v where name like '%2024_01_01' intersect
select regexp_replace(name, '_2024_02_01$', '') from v where name like '%2024_02_01'""")
def _(spark, d):
    v = view(spark, d, _VERSIONS).select(F.regexp_extract("name", r"^(.*)_(\d{4}_\d{2}_\d{2})$", 1).alias("stem"), F.regexp_extract("name", r"(\d{4}_\d{2}_\d{2})$", 1).alias("date"))
    return v.where("date = '2024_01_01'").select("stem").intersect(v.where("date = '2024_02_01'").select("stem"))


@Q.add("org_ids_distinct", "select distinct c_nationkey, c_mktsegment from customer")
def _(spark, d):
    return _read(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()


# --- data quality -----------------------------------------------------------------


def _dq(name, find, *rules):
    """``rules``: (rule, value, condition) in SQL."""
    sql = " union all ".join(f"select id as record_id, '{r}' as rule, cast({v} as varchar) as value from raw where {c}" for r, v, c in rules)
    Q.add(name, sql, "raw")(lambda spark, d: find(domain(spark, d, "raw")))


_CHARS = " or ".join("contains({c}, %s)" % ("chr(9)" if c == "\t" else f"'{c}'") for c in ("@", "&", "#", "~", "*", "\t", "%", "|", "$", "-"))
_P = [x for n in ("provider", "occurrence_date") for x in ((f"{n}_value", n, f"lower({n}) in ('na', '#na', 'n/a', '')"), (f"{n}_character", n, _CHARS.format(c=n)))]
_KING = "lower(kingdom) in ('animalia', 'plantae', 'bacteria', 'fungi', 'protozoa', 'chromista', 'archaea', 'virus')"
_FK = [("fips", "fips", "fips <> '' and length(fips) <> 5"), ("kingdom", "kingdom", f"kingdom <> '' and not {_KING}")]
_N = [
    ("provided_name", "provided_name", "coalesce(provided_name, '') = ''"), ("clean_name", "clean_name", "coalesce(clean_name, '') = ''"),
    ("name_edge_space", "clean_name", "length(trim(clean_name)) < length(clean_name)"), ("name_double_space", "clean_name", "clean_name = 'two  spaces'"), ("name_character", "clean_name", "clean_name = 'a.b'"),
]
_NUM, _OD, _Y = "regexp_matches(occurrence_date, '^[0-9]+(-[0-9]+)*$')", "occurrence_date <> ''", "nullif(year, '')"
_SIMPLE = "len(string_split(occurrence_date, '-')) in (1, 3)"
_D = [
    ("date_not_numeric", "occurrence_date", f"{_OD} and not {_NUM}"), ("date_parts", "occurrence_date", f"{_OD} and {_NUM} and not {_SIMPLE}"), ("date_without_year", "occurrence_date", f"{_OD} and {_NUM} and {_SIMPLE} and {_Y} is null"),
    ("year_differs", "year", f"{_OD} and {_NUM} and {_SIMPLE} and string_split(occurrence_date, '-')[1] <> {_Y}"), ("year_not_numeric", "year", f"{_Y} is not null and try_cast(year as int) is null"), ("year_range", "year", "try_cast(year as int) < 1500 or try_cast(year as int) > 2020"),
]
_DEP = [
    ("tsn", "tsn", "tsn is not null and accepted_name is null"),
    ("sign", "lon || ' ' || lat", "country in ('US', 'CA') and (try_cast(lon as double) > 0 or try_cast(lat as double) < 0)"), ("thumb", "thumb", "thumb is not null and media is null"),
]
_PROV = [
    ("habitat", "habitat", "habitat <> 'field'"), ("lang", "lang", "lang is distinct from 'en'"), ("kingdom", "kingdom", f"kingdom <> '' and not {_KING}"),
    ("kingdom_case", "kingdom", f"{_KING} and kingdom <> upper(substring(kingdom, 1, 1)) || lower(substring(kingdom, 2))"), ("country", "country", "country not in ('AS', 'CA', 'FM', 'GU', 'MH', 'MP', 'PR', 'P', 'UM', 'US', 'VI')"),
]
_U = "string_split(resource_url, '=')"
_RU = [
    ("url_parts", "resource_url", f"len({_U}) <> 2"), ("url_prefix", "resource_url", f"len({_U}) = 2 and {_U}[1] <> 'https://host/ipt/resource?r'"),
    ("url_id", "resource_url", f"len({_U}) = 2 and {_U}[1] = 'https://host/ipt/resource?r' and {_U}[2] is distinct from resource_id"),
]
_CONST = {"habitat": "field", "lang": "en"}

_dq("dq_prohibited", lambda r: quality.prohibited(r, "id", ["provider", "occurrence_date"]).unionByName(quality.field_count(r, "id", F.split("occurrence_date", "-", -1), 3)), *_P, ("field_count", "len(string_split(occurrence_date, '-'))", "len(string_split(occurrence_date, '-')) <> 3"))
_dq("dq_fips_kingdom", lambda r: quality.fips_kingdom(r, "id"), *_FK)
_dq("dq_name", lambda r: quality.names(r, "id"), *_N)
_dq("dq_dates", lambda r: quality.dates(r, "id", 2020), *_D)
_dq("dq_dependent", lambda r: quality.dependent(r, "id"), *_DEP)
_dq("dq_provider", lambda r: quality.provider(r, "id", _CONST), *_PROV)
_dq("dq_resource_url", lambda r: quality.resource_url(r, "id", "resource_url", "resource_id", "https://host/ipt/resource?r"), *_RU)
_PN = [(r.replace("provider", "provided_name").replace("occurrence_date", "clean_name"), v.replace("provider", "provided_name").replace("occurrence_date", "clean_name"), c.replace("provider", "provided_name").replace("occurrence_date", "clean_name")) for r, v, c in _P]
_dq("dq_run", lambda r: quality.run(r, "id", 2020, _CONST), *_PN, *_FK, *_N, *_D, *_DEP, *_PROV)


@Q.add("dq_counts", " union all ".join(f"select '{r}' as rule, count(*) as n from raw where {c} having count(*) > 0" for r, _v, c in _D), "raw")
def _(spark, d):
    return quality.by_rule(quality.dates(domain(spark, d, "raw"), "id", 2020))


# --- jobs -------------------------------------------------------------------------


@Q.add("job_summarize_combine", f"> {_SUMMARY} select distinct location_type, location, 'good' as verdict from sm", "ann")
def _(spark, d):
    ann = annotated_table(spark, d)
    return counts.compare_counts(counts.combine(*_parts(ann)), counts.location_summary(ann))


@Q.add("job_region_reports", _pivot_sql(), "ann", "keyed")
def _(spark, d):
    """Region lists written by type, read again for the shares of each status."""
    path = io.scratch(spark, "regions")
    io.write_by(_aggregate(spark, d), path, "location_type")
    rows = spark.read.parquet(path)
    return counts.status_pivot(rows, "location_type", "location", statuses=_STATUS)


@Q.add("job_group_by_state", "select gbifid, taxonkey, census_state from ann where census_state is not null", "ann")
def _(spark, d):
    path = io.scratch(spark, "states")
    io.write_by(annotated_table(spark, d).where("census_state is not null"), path, "census_state", columns=["gbifid", "taxonkey"])
    return spark.read.parquet(path).select("gbifid", "taxonkey", F.col("census_state").cast("string").alias("census_state"))
