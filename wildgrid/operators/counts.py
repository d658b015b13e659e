"""Counts and lists by region, status, provider and location.

Species counts are exact; group keys with a third of all rows are summed before
the shuffle like all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .register import NATIVE

#: Region types: key column, and whether regions leave no point uncovered (then an empty location is an error).
REGIONS = {"state": ("census_state", True), "county": ("state_county", True), "aiannh": ("aiannh_name", False)}
INTRODUCED, INVASIVE = "introduced", "invasive"


def region_counts(ann: DataFrame, region: str, *more: str) -> DataFrame:
    """occ_count and species_count of each region (and status); rows without region or species are left out."""
    kept = ann.where(F.col(region).isNotNull() & F.col("species").isNotNull())
    return kept.groupBy(region, *more).agg(F.count("*").alias("occ_count"), F.countDistinct("taxonkey").alias("species_count"))


def species_list(ann: DataFrame, *keys: str) -> DataFrame:
    """occ_count of each species and status in each region; only the state must be known, so a region may be null."""
    kept = ann.where(F.col("census_state").isNotNull() & F.col("species").isNotNull())
    return kept.groupBy(*keys, "taxonkey_species", "taxonkey", "species", "riis_assessment").agg(F.count("*").alias("occ_count"))


#: What is delivered of a month: name to (region columns, more keys, whether a list of species), and the order of its file.
PRODUCTS = {
    **{f"counts_{t}": ((c,), (), False) for t, (c, _) in REGIONS.items()},
    **{f"counts_{t}_x_riis": ((c,), ("riis_assessment",), False) for t, (c, _) in REGIONS.items()},
    "list_state": (("census_state",), (), True),
    "list_county": (("state_county", "census_state", "census_county"), (), True),
    "list_aiannh": (("aiannh_name",), (), True),
}


def product(ann: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """One of ``PRODUCTS`` and the columns by which its file is ordered: region, then species, then what tells rows of these apart."""
    regions, more, is_list = PRODUCTS[name]
    if is_list:
        return species_list(ann, *regions), [regions[0], "species", "taxonkey_species", "riis_assessment"]
    return region_counts(ann, *regions, *more), [*regions, *more]


def totals(ann: DataFrame, column: str) -> DataFrame:
    return ann.groupBy(column).agg(F.count("*").alias("total"))


def coverage(ann: DataFrame) -> DataFrame:
    return ann.agg(F.count("*").alias("total"), F.count("census_state").alias("with_state"), F.count("riis_occurrence_id").alias("with_register"))


def location_summary(ann: DataFrame) -> DataFrame:
    """(location_type, location, region_species, species, count) over all region types in one pass."""
    each = [F.struct(F.lit(t).alias("location_type"), F.col(c).alias("location")) for t, (c, _) in REGIONS.items()]
    key = F.concat_ws("__", "riis_region", F.col("taxonkey").cast("string"))
    rows = ann.where("species is not null").select(F.explode(F.array(*each)).alias("x"), key.alias("region_species"), "species")
    return rows.where("x.location is not null").groupBy("x.location_type", "x.location", "region_species", "species").agg(F.count("*").alias("count"))


def location_violations(ann: DataFrame) -> DataFrame:
    """(location_type, n): rows without location in region types that cover everything."""
    each = F.array(*[F.struct(F.lit(t).alias("location_type"), F.col(c).isNull().alias("none")) for t, (c, whole) in REGIONS.items() if whole])
    return ann.select(F.explode(each).alias("x")).groupBy("x.location_type").agg(F.count_if("x.none").alias("n"))


def combine(*summaries: DataFrame) -> DataFrame:
    """Sums of summaries of parts."""
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    keys = [c for c in out.columns if c != "count"]
    return out.groupBy(*keys).agg(F.sum("count").alias("count"))


def summary_report(summary: DataFrame) -> DataFrame:
    """Species and occurrences of each location."""
    return summary.groupBy("location_type", "location").agg(F.countDistinct("region_species").alias("species"), F.sum("count").alias("occurrences"))


def species_in(summary: DataFrame, kind: str, location: str) -> DataFrame:
    return summary.where((F.col("location_type") == kind) & (F.col("location") == location)).groupBy("region_species", "species").agg(F.sum("count").alias("count"))


def locations_of(summary: DataFrame, kind: str) -> DataFrame:
    return summary.where(F.col("location_type") == kind).select("location").distinct()


def species_lookup(summary: DataFrame) -> DataFrame:
    return summary.groupBy("region_species").agg(F.min("species").alias("species"))


def region_aggregate(summary: DataFrame, register: DataFrame) -> DataFrame:
    """Species of each location with count and assessment of their region and key; presumed native without entry."""
    parts = F.split("region_species", "__")
    s = summary.where("location <> 'na'").withColumns({"region": F.get(parts, F.lit(0)), "key": F.get(parts, F.lit(1)).try_cast("int")})
    j = s.join(register.select(F.col("locality").alias("region"), "key", "riis_assessment"), ["region", "key"], "left")
    return j.select("location_type", "location", "key", "species", "count", F.coalesce("riis_assessment", F.lit(NATIVE)).alias("assessment"))


def status_pivot(rows: DataFrame, *keys: str, statuses: tuple[str, ...] = (INTRODUCED, INVASIVE, NATIVE)) -> DataFrame:
    """(keys, key, count, assessment) -> species and occurrences of each status, totals, and shares to 3 places (null without any)."""
    one = {s: F.col("assessment") == s for s in statuses}
    sums = [x for s, c in one.items() for x in (F.countDistinct(F.when(c, F.col("key"))).alias(f"{s}_species"), F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0)).alias(f"{s}_occs"))]
    g = rows.groupBy(*keys).agg(*sums, F.countDistinct("key").alias("species"), F.sum("count").alias("occs"))
    return g.withColumns({f"pct_{s}_{what}": F.round(F.try_divide(F.col(f"{s}_{what}"), F.col(total)), 3) for s in statuses for what, total in (("species", "species"), ("occs", "occs"))})


def provider_counts(df: DataFrame, provider: str, resource: str) -> DataFrame:
    """(kind, id, n): records of each provider and of each resource."""
    each = F.array(F.struct(F.lit("provider").alias("kind"), F.col(provider).alias("id")), F.struct(F.lit("resource").alias("kind"), F.col(resource).alias("id")))
    return df.select(F.explode(each).alias("x")).groupBy("x.kind", "x.id").agg(F.count("*").alias("n"))


def split_provider(ids: DataFrame, column: str) -> DataFrame:
    """Legacy 'provider,resource' ids as two columns; null unless there are two parts."""
    p = F.split(column, ",")
    two = F.size(p) == 2
    return ids.withColumns({"provider": F.when(two, F.get(p, F.lit(0))), "resource": F.when(two, F.get(p, F.lit(1)))})


def mismatches(df: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """Rows whose text differs from the lookup's, nulls included."""
    j = df.join(lookup.select(F.col(key), F.col(column).alias("expected")), key)
    return j.where(~F.col(column).eqNullSafe(F.col("expected")))


def key_sets(df: DataFrame, name: str, key: str) -> DataFrame:
    return df.where(F.col(name).isNotNull()).groupBy(name).agg(F.sort_array(F.collect_set(key)).alias("keys"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def assessment_counts(df: DataFrame, values: tuple[str, ...], column: str = "riis_assessment") -> DataFrame:
    """Rows of each of the given values, 0 where there are none."""
    listed = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return listed.join(value_counts(df, column), column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def location_species_counts(summary: DataFrame) -> DataFrame:
    """(kind, label, count): occurrences of each location and of each species."""
    each = F.array(F.struct(F.lit("location").alias("kind"), F.concat_ws("__", "location_type", "location").alias("label")), F.struct(F.lit("species").alias("kind"), F.col("region_species").alias("label")))
    return summary.select(F.explode(each).alias("x"), "count").groupBy("x.kind", "x.label").agg(F.sum("count").alias("count"))


def compare_counts(parts: DataFrame, whole: DataFrame) -> DataFrame:
    """(location_type, location, verdict): the sums of parts against the combined summary: good, missing or unequal."""
    k = ["location_type", "location"]
    a, b = (s.groupBy(*k).agg(F.sum("count").alias(n)) for s, n in ((parts, "a"), (whole, "b")))
    v = F.when(F.col("a").isNull() | F.col("b").isNull(), "missing").when(F.col("a") == F.col("b"), "good").otherwise("unequal")
    return a.join(b, k, "full").select(*k, v.alias("verdict"))


def annotate_report(source: DataFrame, annotated: DataFrame | Column, key: str, rejected: DataFrame) -> DataFrame:
    """(what, value, n): ids that were not annotated, and the ranks that were rejected with their rows. ``annotated``: a table of those that were, or, if ``source`` tells, the condition."""
    lost = source.where(~annotated) if isinstance(annotated, Column) else source.join(annotated.select(key), key, "left_anti")
    failed = lost.select(F.lit("failed_id").alias("what"), F.col(key).cast("string").alias("value"), F.lit(1).cast("bigint").alias("n"))
    return failed.unionByName(rejected.select(F.lit("rank").alias("what"), F.col("rank").alias("value"), "n"))
