"""Column expressions that clean and derive values of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the record format prohibits, its vocabularies and its constants.
PROHIBITED_VALUES = ("na", "#na", "n/a", "")
PROHIBITED_CHARACTERS = ("@", "&", "#", "~", "*", "\t", "%", "|", "$", "-")
PROHIBITED_NAME_CHARACTERS = (",", "'", '"', ".", "?", "(", ")", "[", "]", "{", "}")
DELIMITER = "$"
KINGDOMS = ("animalia", "plantae", "bacteria", "fungi", "protozoa", "chromista", "archaea", "virus")
COUNTRIES = ("AS", "CA", "FM", "GU", "MH", "MP", "PR", "P", "UM", "US", "VI")
BASIS = {
    "FOSSIL_SPECIMEN": "fossil", "LITERATURE": "literature", "LIVING_SPECIMEN": "living", "HUMAN_OBSERVATION": "observation",
    "MACHINE_OBSERVATION": "observation", "OBSERVATION": "observation", "MATERIAL_SAMPLE": "specimen", "PRESERVED_SPECIMEN": "specimen", "UNKNOWN": "unknown",
}
RANKS = ("SPECIES", "SUBSPECIES", "VARIETY", "FORM", "INFRASPECIFIC_NAME", "INFRASUBSPECIFIC_NAME")
OBSERVED = ("HUMAN_OBSERVATION", "OBSERVATION", "OCCURRENCE", "PRESERVED_SPECIMEN")
NO_PART = "na"
JOINT = "__"


def clean_value(c: Column) -> Column:
    """Trimmed, without the output's delimiter; prohibited values are null."""
    v = F.replace(F.trim(c), F.lit(DELIMITER), F.lit(""))
    return F.when(F.lower(v).isin(*PROHIBITED_VALUES), None).otherwise(v)


def limited(c: Column, kind: str, size: int | None = None) -> Column:
    """Numbers that don't parse are null, longer text is cut."""
    if kind in ("integer", "double"):
        return c.try_cast("int" if kind == "integer" else "double")
    return F.substring(c, 1, size) if size else c


def second_choice(*cs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def vocabulary(c: Column, terms: dict[str, str]) -> Column:
    """Terms recoded; all others unchanged."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in terms.items() for x in kv])[c], c)


def date_part(c: Column) -> Column:
    return F.substring_index(c, "T", 1)


def fixed_date(date: Column, year: Column) -> tuple[Column, Column]:
    """(date without time, year): dates of numeric parts lose their time and give a missing year; others stay."""
    part = date_part(date)
    numeric = part.rlike("^[0-9]+(-[0-9]+)*$")
    y = year.try_cast("int")
    return F.when(numeric, part).otherwise(date), F.coalesce(y, F.when(numeric, F.split(part, "-")[0].try_cast("int")))


def date_numbers(c: Column) -> Column:
    """Parts of a date as numbers; a part that isn't one is null."""
    return F.transform(F.split(date_part(c), "-"), lambda p: p.try_cast("int"))


def first_newer(a: Column, b: Column) -> Column:
    """Whether date ``a`` isn't older than ``b``, part by part; of equal dates the first is meant."""
    return date_numbers(a) >= date_numbers(b)


def fixed_point(lon: Column, lat: Column, country: Column) -> tuple[Column, Column]:
    """Numbers only; (0, 0) is no place; longitudes of US and CA are west."""
    x, y = lon.try_cast("double"), lat.try_cast("double")
    nowhere = (x == 0) & (y == 0)
    west = F.when(country.isin("US", "CA") & (x > 0), -x).otherwise(x)
    return F.when(F.coalesce(nowhere, F.lit(False)), None).otherwise(west), F.when(F.coalesce(nowhere, F.lit(False)), None).otherwise(y)


def both_or_none(lon: Column, lat: Column) -> tuple[Column, Column]:
    x, y = lon.try_cast("double"), lat.try_cast("double")
    whole = x.isNotNull() & y.isNotNull()
    return F.when(whole, x), F.when(whole, y)


def kingdom(c: Column) -> Column:
    """Capitalised, or null if it isn't one of the kingdoms."""
    k = F.lower(c)
    return F.when(k.isin(*KINGDOMS), F.concat(F.upper(F.substring(k, 1, 1)), F.substring(k, 2, 100)))


def without_quotes(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, '^"+|"+$', ""), F.lit(DELIMITER), F.lit(""))


def ascii_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def full_name(name: Column, author: Column) -> Column:
    return F.trim(F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(author, F.lit(""))))


def species_key(key: Column, name: Column) -> Column:
    """Taxon key and name; null if either is."""
    return F.concat(key.cast("string"), F.lit(" "), name)


def place_key(state: Column, county: Column, joint: str = " ") -> Column:
    return F.concat(state, F.lit(joint), county)


def compound_key(*parts: Column) -> Column:
    """Parts joined, those that are ``na`` left out; null if all are."""
    return F.nullif(F.array_join(F.filter(F.array(*parts), lambda p: p != NO_PART), JOINT), F.lit(""))


def key_parts(key: Column) -> Column:
    return F.split(key, JOINT)


def url_parts(url: Column, prefix: str) -> tuple[Column, Column]:
    """(id, standard url) of ``prefix=id``; null unless there are two parts and the prefix is that one."""
    parts = F.split(url, "=")
    good = (F.size(parts) == 2) & (F.get(parts, F.lit(0)) == prefix)
    name = F.when(good, F.get(parts, F.lit(1)))
    return name, F.concat(F.lit(f"{prefix}="), name)


def centroid(wkt: Column) -> tuple[Column, Column]:
    """(lon, lat) of POINT (x y)."""
    xy = F.split(F.trim(F.regexp_extract(wkt, r"\(([^)]*)\)", 1)), r"\s+")
    return F.get(xy, F.lit(0)).try_cast("double"), F.get(xy, F.lit(1)).try_cast("double")


def month_string(d: Column, back: int = 0) -> Column:
    """YYYY_MM_01 of a date's month, or of one ``back`` months before."""
    return F.date_format(F.trunc(F.add_months(d, -back), "MM"), "yyyy_MM_dd")


def integer_or(c: Column, missing: int = -1) -> Column:
    """An empty key is ``missing``, one that is no number null."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(missing)).otherwise(c.try_cast("int"))
