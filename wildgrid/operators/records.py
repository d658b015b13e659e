"""Filters, projections and lookups of occurrence records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wildgrid.functions import text as X


def subset(occ: DataFrame, country: str = "US") -> DataFrame:
    """Present points of one country at species rank or below, of observation or specimen."""
    keep = F.col("lat").isNotNull() & F.col("lon").isNotNull() & (F.col("countrycode") == country) & (F.col("occurrencestatus") == "PRESENT")
    return occ.where(keep & F.col("taxonrank").isin(*X.RANKS) & F.col("basisofrecord").isin(*X.OBSERVED))


def subset_columns(occ: DataFrame) -> DataFrame:
    """Columns of the subset with the species key and the point."""
    point = F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), F.struct("lon", "lat"))
    return occ.select("gbifid", "datasetkey", "publishingorgkey", "taxonkey", "species", "taxonrank", "countrycode", "occurrencestatus", "basisofrecord", "lon", "lat", X.species_key(F.col("taxonkey"), F.col("species")).alias("taxonkey_species"), point.alias("geom"))


def add_null_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast("string") for n in names})


def taxon_keys(df: DataFrame) -> DataFrame:
    """Rows of accepted rank with ``keys``: the accepted key, and the species key where the rank isn't species and it differs."""
    accepted, species = F.col("accepted_key"), F.col("species_key")
    both = (F.lower("rank") != "species") & species.isNotNull() & (accepted != species)
    return df.where(F.lower("rank").isin(*map(str.lower, X.RANKS))).withColumn("keys", F.when(both, F.array(accepted, species)).otherwise(F.array(accepted)))


def rejected_ranks(df: DataFrame) -> DataFrame:
    """(rank, n) of the rows that ``taxon_keys`` leaves out."""
    return df.where(~F.coalesce(F.lower("rank").isin(*map(str.lower, X.RANKS)), F.lit(False))).groupBy("rank").agg(F.count("*").alias("n"))


def rename(df: DataFrame, mapping: dict[str, str], target: list[str]) -> DataFrame:
    """Columns of ``target``: mapped (source: target) or null; all else is dropped."""
    of = {t: s for s, t in mapping.items()}
    return df.select(*[F.col(of[t]).alias(t) if t in of else F.lit(None).cast("string").alias(t) for t in target])


def limit_fields(df: DataFrame, fields: dict[str, tuple[str, int | None]]) -> DataFrame:
    """Fields (name: (varchar, integer or double, longest)) by ``functions.text.limited``."""
    return df.withColumns({n: X.limited(F.col(n), kind, size) for n, (kind, size) in fields.items()})


def discard(df: DataFrame, name: str, key: str, status: str) -> DataFrame:
    """Without rows that have neither name nor key, and absences; an unknown status stays."""
    return df.where(~(F.col(name).isNull() & F.col(key).isNull()) & ~F.coalesce(F.lower(status) == "absent", F.lit(False)))


def all_strings(df: DataFrame, f) -> DataFrame:
    return df.withColumns({n: f(F.col(n)) for n, t in df.dtypes if t == "string"})


def provider_constants(df: DataFrame, values: dict[str, str], url: str, prefix: str) -> DataFrame:
    """Constants; the provider's url only where it doesn't begin with its own prefix."""
    own = F.coalesce(F.startswith(F.col(url), F.lit(prefix)), F.lit(False))
    return df.withColumns({**{n: F.lit(v) for n, v in values.items()}, url: F.when(own, F.col(url)).otherwise(prefix)})


def rewrite_resource(df: DataFrame, actions: DataFrame, key: str, prefix: str) -> DataFrame:
    """Records with the id, name and url of their resource's action.

    add, rename, replace_rename: all from the action; replace, rewrite: a name that is
    there stays, the url is always the action's. Records without action are unchanged.
    ``known`` tells whether the record's url named the same resource.
    """
    a = actions.select(F.col(key), F.col("action"), F.col("new_id"), F.col("new_name"), F.concat(F.lit(f"{prefix}="), "new_id").alias("new_url"))
    j = df.join(a, key, "left")
    renamed = F.col("action").isin("add", "rename", "replace_rename")
    acted = F.col("action").isNotNull()
    name = F.when(renamed, F.col("new_name")).when(acted, X.second_choice(F.col("resource"), F.col("new_name"))).otherwise(F.col("resource"))
    own_id, _ = X.url_parts(F.col("resource_url"), prefix)
    changed = {"known": own_id.eqNullSafe(F.col("new_id")), "resource": name, "resource_url": F.when(acted, F.col("new_url")).otherwise(F.col("resource_url")), "resource_id": F.when(acted, F.col("new_id")).otherwise(F.col("resource_id"))}
    return j.withColumns(changed).drop("action", "new_id", "new_name", "new_url")


def county_values(df: DataFrame) -> DataFrame:
    """State, county and code from US attributes, else from Canadian ones."""
    code = F.concat("state_fips", "county_fips")
    return df.withColumns({"b_state": F.coalesce("state_name", F.replace(F.col("prname"), F.lit(" Canada"), F.lit(""))), "b_county": F.coalesce("name", "cdname"), "b_fips": F.coalesce(code, "cduid")})


def state_code(fips: Column, country: Column) -> Column:
    """First two of five characters, unless the country is CA."""
    return F.when((F.length(fips) == 5) & ~country.eqNullSafe(F.lit("CA")), F.substring(fips, 1, 2))


# --- lookups --------------------------------------------------------------------


def priority_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows by their first key that isn't empty (``lookup_key``); without one left out, of several the last in order stays."""
    key = F.coalesce(*[F.nullif(F.trim(F.col(k).cast("string")), F.lit("")) for k in keys])
    row = F.struct(order, *[c for c in df.columns if c != order])
    return df.withColumn("lookup_key", key).where("lookup_key is not null").groupBy("lookup_key").agg(F.max(row).alias("r")).select("lookup_key", "r.*")


def fill(df: DataFrame, lookup: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns from the lookup where the key is found, unchanged elsewhere. The lookup has one row a key."""
    right = lookup.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    j = df.join(right, key, "left")
    have = set(df.columns)
    return j.withColumns({c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c) if c in have else None) for c in columns}).drop("_hit", *[f"_{c}" for c in columns])


def fallback_lookup(df: DataFrame, by: list[tuple[DataFrame, str, str]], value: str) -> DataFrame:
    """The first value found: ``by`` lists (lookup, key of df, key of lookup), each with one row a key."""
    out = df
    for n, (lookup, left, right) in enumerate(by):
        out = out.join(lookup.select(F.col(right).alias(f"_k{n}"), F.col(value).alias(f"_v{n}")), out[left] == F.col(f"_k{n}"), "left").drop(f"_k{n}")
    return out.withColumn(value, F.coalesce(*[f"_v{n}" for n in range(len(by))])).drop(*[f"_v{n}" for n in range(len(by))])


def estimated_means(rows: DataFrame) -> DataFrame:
    """(key, means) for each TSN, or name where there is none: what is filled of AK, HI and L48, joined by spaces. First row wins."""
    means = F.concat_ws(" ", *[F.nullif(F.col(c), F.lit("")) for c in ("ak", "hi", "l48")])
    k = rows.select(X.second_choice(F.col("tsn"), F.col("name")).alias("key"), means.alias("means"), "line").where("key is not null")
    return k.groupBy("key").agg(F.min_by("means", "line").alias("means"))


def centroid_lookup(df: DataFrame, centroids: DataFrame, key: str) -> DataFrame:
    """Missing coordinates from the county's centroid by code, else by state and county; county centroids are computed anew."""
    lon, lat = X.centroid(F.col("wkt"))
    c = centroids.select("fips", F.concat("state", F.lit(";"), "county").alias("place"), lon.alias("x"), lat.alias("y"), "line")
    by = lambda k, n: c.where(F.col(k).isNotNull()).groupBy(F.col(k).alias(f"{n}k")).agg(F.min_by(F.struct("x", "y"), "line").alias(n))
    again = F.coalesce(F.col("centroid") == "county", F.lit(False))
    d = df.withColumns({"lon": F.when(~again, F.col("lon")), "lat": F.when(~again, F.col("lat"))})
    d = d.join(by("fips", "a"), d["fips"] == F.col("ak"), "left").join(by("place", "b"), F.concat(d["state"], F.lit(";"), d["county"]) == F.col("bk"), "left")
    xy = F.coalesce("a", "b")
    need = (F.col("lon").isNull() | F.col("lat").isNull()) & xy.isNotNull()
    out = d.withColumns({"lon": F.when(need, xy["x"]).otherwise(F.col("lon")), "lat": F.when(need, xy["y"]).otherwise(F.col("lat")), "centroid": F.when(need, "county").when(~again, F.col("centroid")), "datum": F.when(need, "WGS84")})
    return out.drop("a", "ak", "b", "bk")


def missing_ids(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).join(lookup, key, "left_anti").select(key).distinct()


def merged_lookup(old: DataFrame, new: DataFrame, columns: list[str], no_legacy: str = "-9999") -> DataFrame:
    """Old rows (uuid, legacy_id) with the values of current ones, matched by uuid, else by legacy id; then current ones alone.

    ``key``: the legacy id, or the uuid where that is ``no_legacy`` or missing.
    """
    n = new.select(F.col("uuid").alias("nu"), F.col("legacy_id").alias("nl"), *[F.col(c).alias(f"n_{c}") for c in columns])
    a = old.join(n, old["uuid"] == n["nu"], "left")
    m = n.select(F.col("nu").alias("mu"), F.col("nl").alias("ml"), *[F.col(f"n_{c}").alias(f"m_{c}") for c in columns])
    b = a.join(m, F.col("nu").isNull() & (F.col("legacy_id") == m["ml"]) & (m["ml"] != no_legacy), "left")
    merged = b.select(F.coalesce("nu", "mu", "uuid").alias("uuid"), "legacy_id", *[F.coalesce(f"n_{c}", f"m_{c}", c).alias(c) for c in columns])
    alone = new.join(merged.select("uuid"), "uuid", "left_anti").select("uuid", "legacy_id", *columns)
    key = F.when(F.col("legacy_id").isNull() | (F.col("legacy_id") == no_legacy), F.col("uuid")).otherwise(F.col("legacy_id"))
    return merged.unionByName(alone).withColumn("key", key)


def provider_resource(df: DataFrame, datasets: DataFrame, organisations: DataFrame, own_org: str, own_prefix: str) -> DataFrame:
    """Records with their dataset's and its organisation's fields, but those of the own publisher under the own url."""
    j = df.join(datasets, "dataset_id", "left").join(organisations, "org_id", "left")
    own = (F.col("org_id") == own_org) & F.startswith(F.col("resource_url"), F.lit(own_prefix))
    return j.where(~F.coalesce(own, F.lit(False)))


def merged_names(names: DataFrame, parsed: DataFrame, by_key: DataFrame) -> DataFrame:
    """(name, keys) -> name, canonical: by the parser, else by the first of its keys that resolves."""
    first = names.join(parsed, "name", "left")
    failed = first.where("canonical is null").select("name", F.posexplode("keys").alias("pos", "key"))
    second = failed.join(by_key.withColumnRenamed("canonical", "by_key"), "key").groupBy("name").agg(F.min_by("by_key", "pos").alias("by_key"))
    return first.join(second, "name", "left").select("name", F.coalesce("canonical", "by_key").alias("canonical"))


def resource_actions(tickets: DataFrame, existing: DataFrame, legacy: DataFrame, prefix: str) -> DataFrame:
    """Tickets, and for each existing dataset without one a 'rewrite' with the id of its first parsable record, else the legacy one.

    existing: (dataset, resource_url, line) of records; legacy: (dataset, legacy_id).
    """
    name, _ = X.url_parts(F.col("resource_url"), prefix)
    own = existing.withColumn("rid", name).groupBy("dataset").agg(F.min_by("rid", F.when(F.col("rid").isNotNull(), F.col("line"))).alias("rid"))
    j = tickets.join(own, "dataset", "full").join(legacy, "dataset", "left")
    return j.select("dataset", F.coalesce("action", F.lit("rewrite")).alias("action"), F.coalesce("ticket_id", "rid", "legacy_id").alias("resource_id"))


# --- order ----------------------------------------------------------------------


def sorted_runs(df: DataFrame, key: str, order: str, part: str) -> DataFrame:
    """Rows with run: a new one begins where the key decreases, within each part (file) in input order.

    A part may be any share of all rows: rows lie in range partitions, written once; a run's
    number is that in its range, with what one row for each range and part says of those before.
    """
    from wildgrid.sources import io

    spark = df.sparkSession
    path = io.scratch(spark, "runs")
    io.write_parquet(df.repartitionByRange(part, order).withColumn("_range", F.spark_partition_id()), path)
    rows = spark.read.parquet(path)
    own = Window.partitionBy("_range", part).orderBy(order)
    down = F.coalesce((F.col(key) < F.lag(key).over(own)).cast("int"), F.lit(0))
    rows = rows.withColumn("_down", down).withColumn("_in", F.sum("_down").over(own.rowsBetween(Window.unboundedPreceding, 0))).drop("_down")
    ends = rows.groupBy("_range", part).agg(F.min_by(key, order).alias("_first"), F.max_by(key, order).alias("_last"), F.max("_in").alias("_downs"))
    before = Window.partitionBy(part).orderBy("_range")
    ends = ends.withColumn("_border", F.coalesce((F.col("_first") < F.lag("_last").over(before)).cast("int"), F.lit(0)))
    upto = F.sum(F.col("_border") + F.col("_downs")).over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_downs")
    ends = ends.select(F.col("_range").alias("_r"), F.col(part).alias("_p"), upto.alias("_before"))
    joined = rows.join(ends, (F.col("_range") == F.col("_r")) & F.col(part).eqNullSafe(F.col("_p")))
    return joined.withColumn("run", (F.col("_before") + F.col("_in")).cast("int")).drop("_range", "_r", "_p", "_before", "_in")


def merge_sorted(key: str, *parts: DataFrame) -> DataFrame:
    """Several tables as one in the order of the key: each range of it is one task's, which merges what the tables have there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.repartitionByRange(key).sortWithinPartitions(key)
