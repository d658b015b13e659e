"""Domain views over the given tables. Each is one SQL text that Spark and DuckDB both read."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wildgrid.operators import records, register, spatial
from wildgrid.sources import io

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

OCC = """
select o_orderkey as gbifid, c_mktsegment as datasetkey, n_name as publishingorgkey,
 cast(o_custkey % 97 as int) as taxonkey,
 case when o_custkey % 53 = 0 then null else concat('Sp ', cast(o_custkey % 97 as string)) end as species,
 case o_orderkey % 8 when 0 then 'SUBSPECIES' when 1 then 'VARIETY' when 2 then 'GENUS' when 3 then 'FAMILY' else 'SPECIES' end as taxonrank,
 case when n_regionkey = 4 then 'CA' else 'US' end as countrycode,
 case o_orderstatus when 'P' then 'ABSENT' else 'PRESENT' end as occurrencestatus,
 case substring(o_orderpriority,1,1) when '1' then 'HUMAN_OBSERVATION' when '2' then 'PRESERVED_SPECIMEN'
   when '3' then 'OBSERVATION' when '4' then 'FOSSIL_SPECIMEN' else 'OCCURRENCE' end as basisofrecord,
 case when o_orderkey % 41 = 0 then null else cast((o_orderkey*7919) % 20011 as double)/20011*50-25 end as lon,
 case when o_orderkey % 43 = 0 then null else cast((o_orderkey*104729) % 20021 as double)/20021*50-25 end as lat,
 o_orderdate as eventdate
from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
"""

POLY = """
select n_nationkey as fid, n_name as name,
 case n_nationkey % 10 when 0 then 'AK' when 1 then 'HI' else concat('S', cast(n_nationkey % 10 as string)) end as stusps,
 cast(-20 + 10*(n_nationkey % 5) as double) as mx, cast(-20 + 10*floor(n_nationkey/5) as double) as my,
 cast(4 + n_nationkey % 3 as double) as r
from nation
"""

NATIVE = """
select n_nationkey as fid, concat('Land ', n_name) as name, concat('G', cast(n_nationkey as string)) as geoid,
 cast(-20 + 10*(n_nationkey % 5) as double) as mx, cast(-20 + 10*floor(n_nationkey/5) as double) as my,
 cast(2 + n_nationkey % 2 as double) as r
from nation where n_nationkey % 3 = 0
"""

AREAS = """
select n_nationkey as fid, concat('Area ', n_name) as name, cast(1 + n_nationkey % 4 as string) as gap,
 case n_nationkey % 10 when 0 then 'AK' when 1 then 'HI' else concat('S', cast(n_nationkey % 10 as string)) end as state,
 cast(-20 + 10*(n_nationkey % 5) as double) as mx, cast(-20 + 10*floor(n_nationkey/5) as double) as my,
 cast(3 + n_nationkey % 4 as double) as r
from nation
"""

RIIS = """
select case p_size % 3 when 0 then 'AK' when 1 then 'HI' else 'L48' end as locality,
 case when p_partkey % 50 = 0 then 'not-a-key' else cast(p_partkey % 97 as string) end as gbif_res_taxonkey,
 p_partkey as occurrenceid, p_type as degreeofestablishment
from part where p_partkey % 4 = 0
"""

STACKED = """
select concat(cast(c_nationkey as string), '_', c_mktsegment) as site, p_name as species, l_quantity as quantity, cast(1 as bigint) as n
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join part on l_partkey = p_partkey
"""

RAW = """
select doc_id as id, source as resource_id,
 case doc_id % 7 when 0 then concat('  ', source, ' ') when 1 then 'N/A' when 2 then '#na' when 3 then concat(source, '$x') when 4 then concat('"', source, '"') when 5 then '' else source end as provider,
 case doc_id % 5 when 0 then 'unknown' when 1 then cast(1990 + doc_id % 30 as string) when 2 then '' else cast(1400 + doc_id % 700 as string) end as year,
 case doc_id % 6 when 0 then '2018-08-01T00:00:00' when 1 then '2018-13' when 2 then 'Aug 2018' when 3 then '1999' when 4 then '2001-05-06' else '' end as occurrence_date,
 case doc_id % 11 when 0 then '0' when 1 then 'abc' else cast((doc_id*7919) % 360 - 180 as string) end as lon,
 case doc_id % 11 when 0 then '0' when 2 then 'x' else cast((doc_id*104729) % 180 - 90 as string) end as lat,
 case doc_id % 4 when 0 then 'US' when 1 then 'CA' when 2 then 'ZZ' else 'PR' end as country,
 case doc_id % 4 when 0 then 'HUMAN_OBSERVATION' when 1 then 'PRESERVED_SPECIMEN' when 2 then 'FOSSIL_SPECIMEN' else 'OTHER' end as basis,
 case doc_id % 5 when 0 then 'animalia' when 1 then 'PLANTAE' when 2 then 'Bogus' when 3 then 'Fungi' end as kingdom,
 case when doc_id % 9 = 0 then null when doc_id % 9 = 1 then concat(' Name ', lang) else concat('Name ', cast(doc_id % 40 as string)) end as provided_name,
 case doc_id % 8 when 0 then null when 1 then 'two  spaces' when 2 then ' edge' when 3 then 'a.b' else 'Genus species' end as clean_name,
 case when doc_id % 6 = 0 then null else doc_id % 40 end as taxon_key,
 case doc_id % 8 when 0 then 'absent' when 1 then null else 'Present' end as status,
 case when doc_id % 2 = 0 then '' else concat('place ', lang) end as verbatim_locality, case when doc_id % 3 = 0 then null else 'near' end as locality, 'field' as habitat,
 case doc_id % 3 when 0 then '12345' when 1 then '123' else '' end as fips,
 case when doc_id % 4 = 0 then 'T1' end as tsn, case when doc_id % 8 = 0 then 'Accepted' end as accepted_name, 'A1' as accepted_tsn,
 case when doc_id % 10 = 0 then 'county' end as centroid, case when doc_id % 7 = 0 then 'thumb' end as thumb, case when doc_id % 14 = 0 then 'media' end as media,
 case doc_id % 4 when 0 then concat('https://host/ipt/resource?r=', source) when 1 then 'https://host/ipt' when 2 then concat('https://other/resource?r=', source) else concat('https://host/ipt/resource?r=', lang) end as resource_url,
 lang, text
from documents
"""

VIEWS = {"occ": OCC, "poly": POLY, "native": NATIVE, "areas": AREAS, "riis": RIIS, "stacked": STACKED, "raw": RAW}


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """``text`` over the tables of a folder; only those that it names are read."""
    used = [t for t in TABLES if re.search(rf"\b(?:from|join) {t}\b", text)]
    put = re.sub(r"\b(from|join) (\w+)\b", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], text)
    return spark.sql(put, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def domain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return view(spark, sf_dir, VIEWS[name])


def layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A polygon layer: its diamond rings as edges."""
    from wildgrid.functions.geometry import edges

    def at(dx: int, dy: int):
        return F.struct((F.col("mx") + dx * F.col("r")).alias("x"), (F.col("my") + dy * F.col("r")).alias("y"))

    ring = F.array(at(1, 0), at(0, 1), at(-1, 0), at(0, -1))
    d = domain(spark, sf_dir, name)
    return d.withColumn("edges", edges(F.array(ring)))


def annotated(spark: SparkSession, sf_dir: str, riis: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """The annotated subset: counties, native lands, region, register (``riis``, or the folder's own); of the records that ``where`` names, else of all.

    Both layers are one index that the points meet once, each point staying one row; of each layer the polygon with the smallest name counts.
    """
    sub = records.subset(domain(spark, sf_dir, "occ"))
    sub = sub if where is None else sub.where(where)
    sub = sub.withColumn("taxonkey_species", F.concat(F.col("taxonkey").cast("string"), F.lit(" "), "species"))
    land = F.lit(True).alias("land")
    both = layer(spark, sf_dir, "poly").select((F.col("fid") * 2).alias("fid"), "edges", "name", F.col("stusps").alias("code"), ~land)
    both = both.toDF("fid", "edges", "name", "code", "land").unionByName(layer(spark, sf_dir, "native").select((F.col("fid") * 2 + 1).alias("fid"), "edges", "name", F.col("geoid").alias("code"), land))
    held = spatial.with_polygons(sub, spatial.index(both, "name", "code", "land"), "_held")
    held = held.withColumns({"_county": spatial.least("_held", "name", "code", where=lambda q: ~q["land"]), "_native": spatial.least("_held", "name", "code", where=lambda q: q["land"])})
    out = held.select(*sub.columns, F.col("_county.code").alias("census_state"), F.col("_county.name").alias("census_county"), F.col("_native.name").alias("aiannh_name"), F.col("_native.code").alias("aiannh_geoid"))
    out = out.withColumn("state_county", F.concat("census_state", F.lit(" "), "census_county"))
    out = out.withColumn("riis_region", register.region_of(F.col("census_state")))
    return register.assess(out, domain(spark, sf_dir, "riis") if riis is None else riis)


#: Tables of ``annotated`` that were written: (application, folder, state of its files) to path.
_ANNOTATED: dict[tuple, str] = {}


def annotated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``annotated`` as a table in the shared folder, which all reports read.

    A session writes it once for each folder, and again when names, lengths or times of the
    folder's files have changed or the table is gone. Each report is then one scan and one aggregate.
    """
    files = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in ("orders", "customer", "nation", "part")])
    state = files.agg(F.count("*"), F.sum("length"), F.max("modificationTime"), F.sum(F.crc32("path"))).first()
    key = (spark.sparkContext.applicationId, sf_dir, *state)
    if key in _ANNOTATED:
        try:
            return spark.read.parquet(_ANNOTATED[key])
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    path = io.scratch(spark, "annotated")
    io.write_parquet(annotated(spark, sf_dir), path)
    _ANNOTATED[key] = path
    return spark.read.parquet(path)


_RANKS = "('SPECIES','SUBSPECIES','VARIETY','FORM','INFRASPECIFIC_NAME','INFRASUBSPECIFIC_NAME')"
SUB = f"""
select * from occ where lat is not null and lon is not null and countrycode = 'US' and occurrencestatus = 'PRESENT'
 and taxonrank in {_RANKS} and basisofrecord in ('HUMAN_OBSERVATION','OBSERVATION','OCCURRENCE','PRESERVED_SPECIMEN')
"""
KEYED = """
select locality, try_cast(gbif_res_taxonkey as int) as key, min(occurrenceid) as riis_occurrence_id, arg_min(degreeofestablishment, occurrenceid) as riis_assessment
from riis where try_cast(gbif_res_taxonkey as int) is not null group by 1, 2
"""
ANN = """
select s.*, cast(taxonkey as string) || ' ' || species as taxonkey_species, census_state, census_county, census_state || ' ' || census_county as state_county, aiannh_name, aiannh_geoid, riis_region, riis_occurrence_id,
 case when riis_region is not null and riis_occurrence_id is null then 'presumed_native' else riis_assessment end as riis_assessment
from (select s.*, c.stusps as census_state, c.name as census_county, l.name as aiannh_name, l.geoid as aiannh_geoid,
   case when c.stusps in ('AK', 'HI') then c.stusps when c.stusps is not null then 'L48' end as riis_region
  from sub s
  left join (select gbifid, arg_min(p.name, p.name) as name, arg_min(stusps, p.name) as stusps from sub join poly p on abs(lon - mx) + abs(lat - my) < r group by gbifid) c using (gbifid)
  left join (select gbifid, arg_min(p.name, p.name) as name, arg_min(geoid, p.name) as geoid from sub join native p on abs(lon - mx) + abs(lat - my) < r group by gbifid) l using (gbifid)) s
left join keyed k on k.locality = s.riis_region and k.key = s.taxonkey
"""
CELLS = "select site as row, species as col, sum(n)::bigint as value from stacked group by 1, 2"

_CTES = {**VIEWS, "sub": SUB, "keyed": KEYED, "ann": ANN, "cells": CELLS}
_NEEDS = {"sub": ["occ"], "keyed": ["riis"], "ann": ["poly", "native", "sub", "keyed"], "cells": ["stacked"]}


def with_views(sql: str, *names: str) -> str:
    """A statement behind the common table expressions of the named views and what they need."""
    order: list[str] = []

    def add(n: str) -> None:
        for m in _NEEDS.get(n, []):
            add(m)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "with " + ", ".join(f"{n} as ({_CTES[n]})" for n in order) + (", " if sql.lstrip().startswith(">") else " ") + sql.lstrip().removeprefix(">")
