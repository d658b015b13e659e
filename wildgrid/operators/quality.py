"""Data-quality rules: each makes rows (record_id, rule, value) of records that break it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wildgrid.functions import text as X


def broken(df: DataFrame, key: str, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``rules``: name to (condition, value to report); a condition that is null isn't met."""
    each = [F.when(c, F.struct(F.lit(n).alias("rule"), v.cast("string").alias("value"))) for n, (c, v) in rules.items()]
    rows = df.select(F.col(key).alias("record_id"), F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x"))
    return rows.select("record_id", "x.rule", "x.value")


def by_rule(found: DataFrame) -> DataFrame:
    return found.groupBy("rule").agg(F.count("*").alias("n"))


def prohibited(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Prohibited values, and values that hold a prohibited character."""
    has = lambda c: F.coalesce(*[F.when(F.contains(c, F.lit(x)), True) for x in X.PROHIBITED_CHARACTERS], F.lit(False))
    rules = {}
    for n in columns:
        rules[f"{n}_value"] = (F.lower(n).isin(*X.PROHIBITED_VALUES), F.col(n))
        rules[f"{n}_character"] = (has(F.col(n)), F.col(n))
    return broken(df, key, rules)


def field_count(df: DataFrame, key: str, fields: Column, expected: int) -> DataFrame:
    return broken(df, key, {"field_count": (F.size(fields) != expected, F.size(fields))})


def fips_kingdom(df: DataFrame, key: str) -> DataFrame:
    return broken(df, key, {"fips": ((F.col("fips") != "") & (F.length("fips") != 5), F.col("fips")), "kingdom": ((F.col("kingdom") != "") & ~F.lower("kingdom").isin(*X.KINGDOMS), F.col("kingdom"))})


def names(df: DataFrame, key: str) -> DataFrame:
    """Columns provided_name and clean_name."""
    c = F.col("clean_name")
    there = F.coalesce(c, F.lit("")) != ""
    edge, double = F.length(F.trim(c)) < F.length(c), F.contains(c, F.lit("  "))
    bad = "[0-9" + "".join("\\" + x for x in X.PROHIBITED_NAME_CHARACTERS) + "]"
    empty = lambda n: F.coalesce(F.col(n), F.lit("")) == ""
    return broken(df, key, {"provided_name": (empty("provided_name"), F.col("provided_name")), "clean_name": (empty("clean_name"), c), "name_edge_space": (there & edge, c), "name_double_space": (there & ~edge & double, c), "name_character": (there & ~edge & ~double & c.rlike(bad), c)})


def dates(df: DataFrame, key: str, now: int) -> DataFrame:
    """Columns occurrence_date and year (text). The year of a date is its first part."""
    d, y = F.nullif(F.col("occurrence_date"), F.lit("")), F.nullif(F.col("year"), F.lit(""))
    parts = F.split(d, "-", -1)
    numeric, simple = d.rlike("^[0-9]+(-[0-9]+)*$"), F.size(parts).isin(1, 3)
    n = y.try_cast("int")
    return broken(df, key, {
        "date_not_numeric": (~numeric, d), "date_parts": (numeric & ~simple, d), "date_without_year": (numeric & simple & y.isNull(), d),
        "year_differs": (numeric & simple & (F.get(parts, F.lit(0)) != y), y), "year_not_numeric": (y.isNotNull() & n.isNull(), y), "year_range": ((n < 1500) | (n > now), y),
    })


def dependent(df: DataFrame, key: str) -> DataFrame:
    """tsn with accepted name and tsn; both coordinates or none; a centroid has them; signs in US and CA; a thumb has media."""
    there = lambda n: F.coalesce(F.col(n).cast("string"), F.lit("")) != ""
    lon, lat = there("lon"), there("lat")
    wrong = (F.col("lon").try_cast("double") > 0) | (F.col("lat").try_cast("double") < 0)
    one = lon != lat
    lost = ~one & there("centroid") & ~lon
    return broken(df, key, {
        "tsn": (there("tsn") & ~(there("accepted_name") & there("accepted_tsn")), F.col("tsn")), "one_coordinate": (one, F.coalesce("lon", "lat")),
        "centroid": (lost, F.col("centroid")), "sign": (~one & ~lost & lon & F.col("country").isin("US", "CA") & wrong, F.concat_ws(" ", "lon", "lat")),
        "thumb": (there("thumb") & ~there("media"), F.col("thumb")),
    })


def provider(df: DataFrame, key: str, constants: dict[str, str]) -> DataFrame:
    rules = {n: (~F.col(n).eqNullSafe(F.lit(v)), F.col(n)) for n, v in constants.items()}
    k = F.col("kingdom")
    known = F.lower(k).isin(*X.KINGDOMS)
    rules |= {"kingdom": ((k != "") & ~known, k), "kingdom_case": (known & (k != X.kingdom(k)), k), "country": ((F.col("country") != "") & ~F.col("country").isin(*X.COUNTRIES), F.col("country"))}
    return broken(df, key, rules)


def resource_url(df: DataFrame, key: str, url: str, resource: str, prefix: str) -> DataFrame:
    """Record url against its standard form: not two parts, another prefix, another id."""
    u = F.col(url)
    p = F.split(u, "=", -1)
    two = F.size(p) == 2
    return broken(df, key, {"url_parts": (~two, u), "url_prefix": (two & (F.get(p, F.lit(0)) != prefix), u), "url_id": (two & (F.get(p, F.lit(0)) == prefix) & ~F.get(p, F.lit(1)).eqNullSafe(F.col(resource)), u)})


def run(df: DataFrame, key: str, now: int, constants: dict[str, str] | None = None) -> DataFrame:
    """All general rules; with ``constants`` those of the own provider too."""
    found = prohibited(df, key, ["provided_name", "clean_name"]).unionByName(fips_kingdom(df, key)).unionByName(names(df, key)).unionByName(dates(df, key, now))
    return found if constants is None else found.unionByName(dependent(df, key)).unionByName(provider(df, key, constants))
