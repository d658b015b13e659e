"""The species register: resolving its names, and assessing records by region and taxon.

A register row has locality (AK, HI or L48), gbif_res_taxonkey (text), occurrenceid and
degreeofestablishment. Where several rows meet a record, the smallest occurrenceid counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NATIVE = "presumed_native"
LOWER = "L48"


def region_of(state: Column) -> Column:
    """AK and HI themselves, other states L48, none null."""
    return F.when(state.isin("AK", "HI"), state).when(state.isNotNull(), LOWER)


def by_taxon(register: DataFrame) -> DataFrame:
    """One row for each locality and numeric taxon key."""
    r = register.withColumn("key", F.col("gbif_res_taxonkey").try_cast("int")).where("key is not null")
    return r.groupBy("locality", "key").agg(F.min("occurrenceid").alias("riis_occurrence_id"), F.min_by("degreeofestablishment", "occurrenceid").alias("riis_assessment"))


def assess(df: DataFrame, register: DataFrame, taxon: str = "taxonkey") -> DataFrame:
    """Records (with riis_region) with the register's id and assessment; in a region without entry they are presumed native."""
    r = by_taxon(register)
    j = df.join(r, (df["riis_region"] == r["locality"]) & (df[taxon] == r["key"]), "left").drop("locality", "key")
    return j.withColumn("riis_assessment", presumed(F.col("riis_region"), F.col("riis_occurrence_id"), F.col("riis_assessment")))


def presumed(region: Column, entry: Column, assessment: Column) -> Column:
    return F.when(region.isNotNull() & entry.isNull(), NATIVE).otherwise(assessment)


def assess_keys(df: DataFrame, register: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """(key, keys array, riis_region) with assessment, lower-cased: the last match in the order of keys, then of lines; else presumed native.

    Of a region's lines of one taxon only the last can win, so a record meets one row for each of its keys, however many lines the register has.
    ``most``: how many keys a record has at most, where that is known (more are an error). Records then look up each place of keys
    and stay one row, not grouped or joined back; the reduced register is written first, so Spark knows whether it is small.
    """
    r = register.select("locality", F.col("gbif_res_taxonkey").try_cast("int").alias("k"), F.lower("degreeofestablishment").alias("a"), "occurrenceid").where("k is not null")
    line = F.struct("occurrenceid")
    r = r.groupBy("locality", "k").agg(F.max_by("a", line).alias("a"), F.max(line)["occurrenceid"].alias("occurrenceid"))
    if most is not None:
        return _assess_places(df, r, most)
    e = df.select(key, "riis_region", F.posexplode("keys").alias("pos", "k"))
    last = e.join(r, (e["riis_region"] == r["locality"]) & (e["k"] == r["k"])).groupBy(key).agg(F.max_by("a", F.struct("pos", "occurrenceid")).alias("assessment"))
    return df.join(last, key, "left").withColumn("assessment", F.coalesce("assessment", F.lit(NATIVE)))


def _assess_places(df: DataFrame, lines: DataFrame, most: int) -> DataFrame:
    """``assess_keys`` by one lookup for each place of keys."""
    from wildgrid.sources import io

    path = io.scratch(df.sparkSession, "register-lines")
    io.write_parquet(lines.select("locality", "k", "a"), path)
    lines, out = df.sparkSession.read.parquet(path), df
    for pos in range(most):
        one = lines.toDF(f"_l{pos}", f"_k{pos}", f"_a{pos}")
        out = out.join(one, (F.col("riis_region") == F.col(f"_l{pos}")) & (F.get("keys", F.lit(pos)) == F.col(f"_k{pos}")), "left")
    found = F.when(F.size("keys") > most, F.raise_error(f"a record has more than {most} keys"))
    for pos in reversed(range(most)):
        found = found.when(F.col(f"_k{pos}").isNotNull(), F.col(f"_a{pos}"))
    return out.select(*df.columns, F.coalesce(found, F.lit(NATIVE)).alias("assessment"))


def assessment_map(register: DataFrame) -> DataFrame:
    """(key, assessments): a map of locality to assessment for each taxon; the last line wins."""
    r = register.withColumn("key", F.col("gbif_res_taxonkey").try_cast("int")).where("key is not null")
    one = r.groupBy("key", "locality").agg(F.max_by("degreeofestablishment", "occurrenceid").alias("a"))
    return one.groupBy("key").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("locality", "a")))).alias("assessments"))


def typed(register: DataFrame) -> DataFrame:
    """Rows with key: -1 for an empty one, null for one that is no number (``bad``)."""
    from wildgrid.functions.text import integer_or

    k = integer_or(F.col("gbif_res_taxonkey"))
    return register.withColumn("key", k).withColumn("bad", F.col("key").isNull())


def resolve(names: DataFrame, matches: DataFrame, by_key: DataFrame) -> DataFrame:
    """(name, kingdom, old_key) -> with new_key, new_name: the accepted taxon of a backbone's match table.

    matches: query_name, kingdom, match_type, status, usage_key, usage_name,
    accepted_key, alternatives array<struct<status,key,accepted_key,name>>; by_key: key, name.
    No match: null. Accepted: its own key and name. Else the accepted key, whose name is
    looked up; without one, the first accepted alternative, key and name together, or
    the first alternative's accepted key.
    """
    m = matches.where("coalesce(match_type, 'NONE') <> 'NONE'")
    ok = F.lower("status") == "accepted"
    alt = F.get(F.filter("alternatives", lambda a: F.lower(a["status"]) == "accepted"), F.lit(0))
    other = F.get(F.filter("alternatives", lambda a: a["accepted_key"].isNotNull()), F.lit(0))
    key = F.when(ok, F.col("usage_key")).otherwise(F.coalesce("accepted_key", alt["key"], other["accepted_key"]))
    name = F.when(ok, F.col("usage_name")).when(F.col("accepted_key").isNull(), alt["name"])
    found = m.select(F.col("query_name").alias("name"), "kingdom", key.alias("new_key"), name.alias("_name"))
    named = by_key.select(F.col("key").alias("new_key"), F.col("name").alias("_by_key"))
    j = names.join(found, ["name", "kingdom"], "left").join(named, "new_key", "left")
    return j.withColumn("new_name", F.coalesce("_name", "_by_key")).drop("_name", "_by_key")


def report(resolved: DataFrame) -> DataFrame:
    """Counts of records, taxa, failures, resolved, updated and written ones."""
    changed = F.col("new_key").isNotNull() & ~F.col("new_key").eqNullSafe(F.col("old_key"))
    return resolved.agg(F.count("*").alias("records"), F.countDistinct("name").alias("taxa"), F.count_if(F.col("new_key").isNull()).alias("failed"), F.count("new_key").alias("resolved"), F.count_if(changed).alias("updated"), F.count("*").alias("written"))


def grouped(register: DataFrame) -> DataFrame:
    """(taxon, ids): entries by resolved key, or standard name where there is none; of one id the last line counts."""
    one = register.groupBy("occurrenceid").agg(F.max(F.struct("line", "key", "name")).alias("r"))
    taxon = F.coalesce(F.col("r.key").cast("string"), F.col("r.name"))
    return one.groupBy(taxon.alias("taxon")).agg(F.sort_array(F.collect_list("occurrenceid")).alias("ids"))


#: Lines of one name that lie in one block at most (about), and pairs that a task compares where blocks allow it.
BLOCK, PAIRS = 4096, 1 << 22


def duplicates(register: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs of lines (a < b) of one name, with what else they share.

    There are as many pairs as the square of a name's lines, from a table that is small, so rows are dealt by pairs and not by bytes: a name's lines
    lie in blocks, and each two blocks (or one with itself) meet in a task of their own choice. A task holds single blocks, however many lines a name has.
    """
    lines = register.select("line", "name", "key", "locality", "assessment").where("line is not null and name is not null")
    n, blocks = F.col("_n"), F.ceil(F.col("_n") / block)
    sizes = lines.groupBy("name").agg(F.count("*").alias("_n")).where("_n > 1").withColumn("_blocks", blocks)
    pairs, meetings = sizes.agg(F.sum(n.cast("double") * n / 2), F.sum(F.col("_blocks") * (F.col("_blocks") + 1) / 2)).first()
    tasks = max(1, min(math.ceil((pairs or 0) / PAIRS), int(meetings or 0)))
    dealt = lines.join(sizes.drop("_n"), "name").withColumn("_at", F.pmod(F.xxhash64("line"), F.col("_blocks")))
    cols = ["line", "key", "locality", "assessment"]

    def side(s: str, i: Column, j: Column) -> DataFrame:
        out = dealt.withColumns({"_i": i, "_j": j})
        return out.select("name", "_i", "_j", *[F.col(c).alias(f"{s}_{c}") for c in cols]).repartition(tasks, "name", "_i", "_j")

    a = side("a", F.col("_at"), F.explode(F.sequence(F.col("_at"), F.col("_blocks") - 1)))
    b = side("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_at"))), F.col("_at"))
    # equal lines lie in one block; what two lines share is the same both ways
    # merged: its size in bytes would have one side broadcast whole, or few tasks
    j = a.join(b.hint("merge"), ["name", "_i", "_j"]).where((F.col("_i") < F.col("_j")) | (F.col("a_line") < F.col("b_line")))
    same = {c: F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in ("key", "locality", "assessment")}
    ends = F.least("a_line", "b_line").alias("a_line"), F.greatest("a_line", "b_line").alias("b_line")
    return j.select(*ends, same["key"].alias("same_key"), same["locality"].alias("same_locality"), (same["assessment"] & same["locality"]).alias("same_assessment_locality"), (same["key"] & same["locality"] & same["assessment"]).alias("duplicate"))
