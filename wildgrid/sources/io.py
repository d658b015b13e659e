"""Readers and writers. Every reader takes a schema or column list, so no pass over the data infers one."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path
from urllib.parse import urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = "gbifid datasetkey occurrenceid kingdom phylum class _order family genus species infraspecificepithet taxonrank scientificname verbatimscientificname verbatimscientificnameauthorship countrycode locality stateprovince occurrencestatus".split()
_MORE = "basisofrecord institutioncode collectioncode catalognumber recordnumber".split()
_LISTS = {"identifiedby", "recordedby", "typestatus", "mediatype", "issue"}

#: The occurrence source in its fixed order: name to type.
OCCURRENCE = {
    **dict.fromkeys(_TEXT, "string"), "individualcount": "int", "publishingorgkey": "string",
    **dict.fromkeys("decimallatitude decimallongitude coordinateuncertaintyinmeters coordinateprecision elevation elevationaccuracy depth depthaccuracy".split(), "double"),
    "eventdate": "timestamp", **dict.fromkeys("day month year taxonkey specieskey".split(), "int"), **dict.fromkeys(_MORE, "string"),
    "identifiedby": "array<string>", "dateidentified": "timestamp", "license": "string", "rightsholder": "string", "recordedby": "array<string>",
    "typestatus": "array<string>", "establishmentmeans": "string", "lastinterpreted": "timestamp", "mediatype": "array<string>", "issue": "array<string>",
}


def occurrence_schema() -> T.StructType:
    return T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in OCCURRENCE.items()))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``; where that is unset, a local one in a local session, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        base = spark.sparkContext.getCheckpointDir()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Paths that ``scratch`` has given, by application.
_SCRATCH: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Deletes everything that this application has written to its scratch paths; frames that read them are void then. Returns the number of paths."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(conf).delete(at, True)
    return len(paths)


# --- sources ------------------------------------------------------------------


def occurrences(spark: SparkSession, path: str) -> DataFrame:
    """Occurrence Parquet in the fixed schema. Lists may be plain or wrapped as array<struct<array_element>>."""
    found = spark.read.parquet(path)
    have = {f.name.lower(): f for f in found.schema.fields}
    out = []
    for name, kind in OCCURRENCE.items():
        if name not in have:
            out.append(F.lit(None).cast(kind).alias(name))
        elif name in _LISTS and isinstance(have[name].dataType, T.ArrayType) and isinstance(have[name].dataType.elementType, T.StructType):
            inner = have[name].dataType.elementType.fieldNames()[0]
            out.append(F.col(f"{have[name].name}.{inner}").cast(kind).alias(name))
        else:
            out.append(F.col(f"`{have[name].name}`").cast(kind).alias(name))
    return found.select(*out)


def parquet_folder(spark: SparkSession, path: str) -> DataFrame | None:
    """All Parquet files below a path; None if there are none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            return None
        raise


def csv(spark: SparkSession, path: str, schema: str, sep: str = ",", encoding: str = "UTF-8", quoted: bool = True, header: bool = True, rest: str | None = None) -> DataFrame:
    """CSV with a given schema; ``rest`` names a column for lines with surplus or malformed fields."""
    reader = spark.read.options(sep=sep, encoding=encoding, header=header, quote='"' if quoted else "", escape='"' if quoted else "\\", enforceSchema=True)
    if rest:
        schema, reader = f"{schema}, `{rest}` string", reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=rest)
    return reader.schema(schema).csv(path)


def register_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The species register: all columns are strings, the header is no row."""
    return csv(spark, path, ", ".join(f"`{c}` string" for c in columns))


def darwin_core(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Tab-delimited Darwin Core text without quoting; the column list is that of its metadata."""
    return csv(spark, path, ", ".join(f"`{c}` string" for c in columns), sep="\t", quoted=False)


def polygons(spark: SparkSession, path: str) -> DataFrame:
    """A polygon layer: attributes and rings, array<array<struct<x,y>>>."""
    layer = spark.read.parquet(path)
    if "rings" not in layer.columns:
        raise ValueError("a polygon layer has a column rings")
    return layer


def jdbc(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """A table (or bracketed query) of a database; give partitionColumn and bounds for large ones."""
    return spark.read.format("jdbc").options(url=url, dbtable=query, **options).load()


def in_file_order(df: DataFrame) -> DataFrame:
    """Rows of one file with position, their place in it from 0. For ordered summaries: one task numbers them."""
    return df.withColumn("_at", F.monotonically_increasing_id()).withColumn("position", F.row_number().over(Window.orderBy("_at")).cast("long") - 1).drop("_at")


def positions(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a Parquet folder with position, their place (from 0) in the files one after another, in the order of their numbers.

    Files count their own rows; only the table of files is summed, so no task sees all rows.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = rows.groupBy("_file").agg(F.count("*").alias("_n"))
    number = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("int")
    before = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(sizes), "_file").withColumn("position", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")  # one row a file


def by_id(df: DataFrame, column: str, value) -> DataFrame:
    """The first record with an id."""
    return df.where(F.col(column) == value).limit(1)


# --- sinks --------------------------------------------------------------------


def write_sorted(df: DataFrame, path: str, *order: str, kind: str = "parquet", mode: str = "overwrite", **options) -> None:
    """One ordered file. Only for summaries: their rows go through one task."""
    writer = df.repartitionByRange(1, *order).sortWithinPartitions(*order).write.mode(mode).options(**options)
    writer.parquet(path) if kind == "parquet" else writer.option("header", True).csv(path)


def write_annotated(df: DataFrame, path: str, state: str = "census_state", geometry: tuple[str, ...] = ("geom",)) -> None:
    """Annotated rows with their state resolved: tab-delimited with header, and Parquet, without geometry."""
    kept = df.where(F.col(state).isNotNull()).drop(*geometry)
    kept.write.mode("overwrite").option("header", True).csv(f"{path}/text", sep="\t")
    kept.write.mode("overwrite").parquet(f"{path}/parquet")


def write_by(df: DataFrame, path: str, *keys: str, columns: list[str] | None = None, kind: str = "parquet") -> None:
    """One folder for each value of the keys.

    Rows are dealt by the keys and rebalanced by what the shuffle measured: a hot value is split over tasks, each of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, and small values share a task, so a folder has few files whatever the number of tasks before.
    """
    kept = df.select(*columns, *[k for k in keys if k not in columns]) if columns else df
    kept = kept.hint("rebalance", *[F.col(k) for k in keys])
    writer = kept.write.mode("overwrite").partitionBy(*keys)
    writer.parquet(path) if kind == "parquet" else writer.option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "snappy") -> None:
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_csv(df: DataFrame, path: str, columns: list[str], overwrite: bool = False, sep: str = ",") -> None:
    """Columns in a fixed order under a header; an existing path is an error unless ``overwrite``."""
    df.select(*columns).write.mode("overwrite" if overwrite else "errorifexists").option("header", True).csv(path, sep=sep)


def write_jdbc(df: DataFrame, url: str, table: str, replace: bool = False, **options) -> None:
    df.write.mode("overwrite" if replace else "append").jdbc(url, table, properties=options)


# --- an embedded database: where no database server is at hand --------------------

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def database(spark: SparkSession, name: str) -> str:
    """Path of a new Derby database in the shared folder, which all must have mounted under one path."""
    at = urlsplit(scratch(spark, name))
    if at.scheme not in ("", "file"):
        raise ValueError(f"an embedded database needs a mounted folder, not {at.scheme}:")
    return at.path


def _connect(spark: SparkSession, url: str):
    """A connection by Derby's own driver, whatever other drivers the session has."""
    return spark._jvm.org.apache.derby.iapi.jdbc.AutoloadedDriver().connect(url, spark._jvm.java.util.Properties())


def make_table(df: DataFrame, at: str, table: str, replace: bool = False) -> None:
    """A table with the frame's columns where there is none; ``replace``: anew and empty. Spark's writer makes it in the driver's process, without a task."""
    write_jdbc(df.limit(0), f"jdbc:derby:{at}/db;create=true", table, replace, **DERBY)


def fill_database(df: DataFrame, at: str, table: str, replace: bool = False) -> None:
    """Appends rows to a table of an embedded database, or replaces it by them.

    A database file admits one process at a time, here the driver's. So executors write the rows as CSV files into the
    shared folder, and the database imports file after file, as a server's bulk load does; no rows are held in the driver's memory.
    """
    if other := [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType, T.DateType))]:
        raise ValueError(f"numbers, texts, booleans and dates can be imported, not {other}")
    spark = df.sparkSession
    make_table(df, at, table, replace)
    files = f"{at}/{uuid.uuid4().hex}"
    # all but null in quotes: the import would cut blanks off
    quoted = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(f"`{c}`").cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(",", *quoted)).write.option("compression", "none").text(f"file://{files}")
    db = _connect(spark, f"jdbc:derby:{at}/db")
    try:
        load = db.prepareCall("call SYSCS_UTIL.SYSCS_IMPORT_TABLE(null, ?, ?, ',', '\"', 'UTF-8', 0)")
        for f in sorted(f for f in Path(files).glob("part-*") if f.stat().st_size):
            load.setString(1, table.upper())
            load.setString(2, str(f))
            load.execute()
    finally:
        db.close()


def open_database(spark: SparkSession, at: str) -> str:
    """The url of an embedded database as it is now, packed for reading: any number of processes may open that."""
    try:
        _connect(spark, f"jdbc:derby:{at}/db;shutdown=true")
    except Py4JJavaError as e:
        if e.java_exception.getSQLState() != "08006":  # the sign that it is shut down
            raise
    packed = f"{at}/{uuid.uuid4().hex}.jar"
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(Path(at, "db").rglob("*")):
            if f.is_file():
                z.write(f, f.relative_to(at))
    return f"jdbc:derby:jar:({packed})db"


def jdbc_parts(spark: SparkSession, url: str, table: str, column: str, parts: int | None = None, **options) -> DataFrame:
    """A table of a database read by several tasks, each a range of a numeric column."""
    name = f'"{column}"'
    low, high = jdbc(spark, url, f"(select min({name}) as low, max({name}) as high from {table}) q", **options).first()
    if low is None:
        return jdbc(spark, url, table, **options)
    parts = parts or spark.sparkContext.defaultParallelism
    return jdbc(spark, url, table, partitionColumn=column, lowerBound=low, upperBound=high + 1, numPartitions=parts, **options)


def write_table(df: DataFrame, name: str) -> DataFrame:
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bundle(tables: dict[str, DataFrame], path: str, metadata: dict | None = None, by: dict[str, str] | None = None) -> None:
    """Several tables and one row of JSON metadata below one path; ``by``: tables that lie in folders by a column."""
    import json

    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        if by and name in by:
            write_by(df, f"{path}/{name}", by[name])
        else:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
    spark.createDataFrame([(json.dumps({**(metadata or {}), "tables": sorted(tables)}, sort_keys=True),)], "metadata string").coalesce(1).write.mode("overwrite").json(f"{path}/_metadata_")


def read_bundle(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    import json

    meta = json.loads(spark.read.schema("metadata string").json(f"{path}/_metadata_").first()[0])
    return {n: spark.read.parquet(f"{path}/{n}") for n in meta["tables"]}, meta
