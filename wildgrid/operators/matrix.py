"""Region-by-species matrices in long form: cells (row, col, value), value > 0, one for each pair. Never pivoted wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AXES = {0: "row", 1: "col"}


def build(stacked: DataFrame, row: str, col: str, value: str) -> DataFrame:
    """Cells of a stacked list; rows without a label are left out, repeated pairs summed."""
    kept = stacked.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return kept.groupBy(F.col(row).alias("row"), F.col(col).alias("col")).agg(F.sum(value).alias("value")).where("value > 0")


def keep_between(cells: DataFrame, least: int | None = None, most: int | None = None) -> DataFrame:
    """Cells within bounds, each 1 or more, one at least given. Empty rows and columns vanish by themselves."""
    if least is None and most is None or any(b is not None and b < 1 for b in (least, most)):
        raise ValueError("least or most is needed, and bounds are 1 or more")
    out = cells if least is None else cells.where(F.col("value") >= least)
    return out if most is None else out.where(F.col("value") <= most)


def shape(cells: DataFrame) -> DataFrame:
    return cells.agg(F.countDistinct("row").alias("rows"), F.countDistinct("col").alias("cols"))


def vector(cells: DataFrame, label: str, axis: int = 0) -> DataFrame:
    """One row (axis 0) or column; a label that isn't there is an error."""
    found = cells.where(F.col(AXES[axis]) == label)
    if found.limit(1).count() == 0:
        raise KeyError(label)
    return found.select(F.col(AXES[1 - axis]).alias("label"), "value")


def vector_sums(cells: DataFrame, axis: int = 0, least: int | None = None) -> DataFrame:
    """(label, total, count) of every row or column, of values of ``least`` and more if given."""
    kept = cells if least is None else cells.where(F.col("value") >= least)
    return kept.groupBy(F.col(AXES[axis]).alias("label")).agg(F.sum("value").alias("total"), F.count("*").alias("count"))


def row_labels(cells: DataFrame, col: str, value: int | None = None) -> DataFrame:
    kept = cells.where(F.col("col") == col)
    return (kept if value is None else kept.where(F.col("value") == value)).select(F.col("row").alias("label"))


def extremes(cells: DataFrame, axis: int = 0, largest: bool = True) -> DataFrame:
    """(label, value, labels): each vector's extreme value and all labels that have it."""
    own, other = AXES[axis], AXES[1 - axis]
    best = cells.groupBy(own).agg((F.max if largest else F.min)("value").alias("value"))
    return cells.join(best, [own, "value"]).groupBy(F.col(own).alias("label"), "value").agg(F.sort_array(F.collect_list(other)).alias("labels"))


def one_stats(cells: DataFrame, axis: int = 0) -> DataFrame:
    """Of every vector: total, count, least, most, number at least, labels at most."""
    own, other = AXES[axis], AXES[1 - axis]
    a = cells.groupBy(own).agg(F.sum("value").alias("total"), F.count("*").alias("count"), F.min("value").alias("least"), F.max("value").alias("most"))
    j = cells.join(a, own)
    at = j.groupBy(own).agg(F.count_if(F.col("value") == F.col("least")).alias("n_least"), F.sort_array(F.collect_list(F.when(F.col("value") == F.col("most"), F.col(other)))).alias("most_labels"))
    return a.join(at, own).withColumnRenamed(own, "label")


#: Share of the rows beside the median, on each side, that ``medians`` looks at one by one.
NEAR = 0.001


def medians(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the exact median of each column, null without values.

    A sketch gives values that surely enclose the median; those below are counted, and only the few between
    are sorted, by their distinct values. So no task holds all values, as an exact percentile's would.
    """
    sketch = {c: F.percentile_approx(c, [0.5 - NEAR, 0.5 + NEAR], F.lit(10 * int(1 / NEAR))) for c in columns}
    bounds = df.agg(*[x.alias(f"_{c}") for c, x in sketch.items()])
    out = None
    for c in columns:
        low, high = F.get(f"_{c}", 0), F.get(f"_{c}", 1)
        rows = df.where(F.col(c).isNotNull()).select(c).crossJoin(F.broadcast(bounds.select(f"_{c}")))  # one row
        counted = rows.groupBy(F.when(F.col(c) < low, None).when(F.col(c) > high, None).otherwise(F.col(c)).alias("_v"), (F.col(c) < low).alias("_below")).agg(F.count("*").alias("_n"))
        # about 2 NEAR of the values at most, and one row each for those below and above
        order = Window.orderBy(F.col("_below").desc(), F.col("_v").asc_nulls_last())
        ranked = counted.withColumn("_upto", F.sum("_n").over(order)).withColumn("_all", F.sum("_n").over(Window.partitionBy()))
        at = lambda k: F.min(F.when((F.col("_upto") >= k) & F.col("_v").isNotNull(), F.col("_v")))
        one = ranked.agg(((at(F.floor((F.col("_all") + 1) / 2)) + at(F.floor(F.col("_all") / 2) + 1)) / 2).alias(c))
        out = one if out is None else out.crossJoin(F.broadcast(one))
    return out


def all_stats(cells: DataFrame, axis: int = 0) -> DataFrame:
    """One row over all vectors: least, mean, median, most of counts and totals, number at the least, labels at the most, grand total.

    The vectors' sums are written once. ``all_extremes`` gives the labels as rows, for as many as there may be.
    """
    from wildgrid.sources import io

    spark, path = cells.sparkSession, io.scratch(cells.sparkSession, "vectors")
    sums = vector_sums(cells, axis)
    io.write_parquet(sums, path)
    v = spark.read.schema(sums.schema).parquet(path)
    kinds = ("count", "total")
    a = v.agg(F.count("*").alias("vectors"), F.sum("total").alias("grand_total"), *[f(k).alias(f"{n}_{k}") for k in kinds for n, f in (("min", F.min), ("mean", F.avg), ("max", F.max))])
    a = a.crossJoin(F.broadcast(medians(v, *kinds).toDF(*[f"median_{k}" for k in kinds])))  # one row
    a = a.select("vectors", "grand_total", *[f"{n}_{k}" for k in kinds for n in ("min", "mean", "median", "max")])
    j = v.crossJoin(F.broadcast(a))
    at = [x for k in kinds for x in (F.count_if(F.col(k) == F.col(f"min_{k}")).alias(f"n_min_{k}"), F.sort_array(F.collect_list(F.when(F.col(k) == F.col(f"max_{k}"), F.col("label")))).alias(f"max_{k}_labels"))]
    return a.crossJoin(F.broadcast(j.agg(*at)))


def all_extremes(cells: DataFrame, axis: int = 0) -> DataFrame:
    """(measure, extreme, label, value): every vector that has the least or most count or total of all, a row each."""
    v = vector_sums(cells, axis)
    kinds = [(k, n, f) for k in ("count", "total") for n, f in (("min", F.min), ("max", F.max))]
    rows = v.crossJoin(F.broadcast(v.agg(*[f(k).alias(f"{n}_{k}") for k, n, f in kinds])))  # one row
    each = F.array(*[F.struct(F.lit(k).alias("measure"), F.lit(n).alias("extreme"), F.col("label").cast("string").alias("label"), F.col(k).alias("value"), (F.col(k) == F.col(f"{n}_{k}")).alias("is")) for k, n, _ in kinds])
    return rows.select(F.explode(F.filter(each, lambda e: e["is"])).alias("e")).select("e.measure", "e.extreme", "e.label", "e.value")


def axis_totals(cells: DataFrame, axis: int = 0) -> DataFrame:
    return vector_sums(cells, axis).select("label", "total")


def axis_counts(cells: DataFrame, axis: int = 0) -> DataFrame:
    return vector_sums(cells, axis).select("label", "count")


def compare(cells: DataFrame, label: str, axis: int = 0) -> DataFrame:
    """One vector's statistics beside those over all vectors."""
    one = one_stats(cells, axis).where(F.col("label") == label)
    return one.crossJoin(F.broadcast(all_stats(cells, axis)))


def random_labels(cells: DataFrame, n: int, axis: int = 0, seed: int = 1) -> DataFrame:
    """n labels in the order of a seeded hash."""
    labels = cells.select(F.col(AXES[axis]).cast("string").alias("label")).distinct()
    return labels.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "label").cast("binary")), "label").limit(n)


def summary(cells: DataFrame, axis: int = 0) -> DataFrame:
    """axis 0: of each species, regions and total; axis 1: of each region, species and total."""
    return vector_sums(cells, 1 - axis)


def summary_row(table: DataFrame, label: str) -> DataFrame:
    found = table.where(F.col("label") == label)
    if found.limit(1).count() == 0:
        raise KeyError(label)
    return found


def rank(table: DataFrame, by: str, largest: bool = True, n: int = 10) -> DataFrame:
    """The n first by a measure, ties with the last kept.

    Fewer than n rows are before the n-th value: these get their ranks in one window; all
    rows of that value, however many, have the next rank in common.
    """
    order = F.col(by).desc_nulls_last() if largest else F.col(by).asc_nulls_last()
    top = table.orderBy(order).limit(n).select(by)
    last = top.agg((F.min if largest else F.max)(by).alias("_last"))
    bound = top.crossJoin(F.broadcast(last)).agg(F.first("_last").alias("_last"), F.count_if(F.col(by) != F.col("_last")).alias("_before"))  # one row
    rows = table.crossJoin(F.broadcast(bound))
    above = F.col(by) > F.col("_last") if largest else F.col(by) < F.col("_last")
    first = rows.where(above).drop("_last", "_before").withColumn("rank", F.rank().over(Window.orderBy(order)))
    tied = rows.where(F.col(by) == F.col("_last")).withColumn("rank", (F.col("_before") + 1).cast("int")).drop("_last", "_before")
    return first.unionByName(tied)


def concat_columns(*parts: DataFrame) -> DataFrame:
    """Series (label, value) side by side: (label, v0, v1, ...), null where one lacks the label."""
    out = parts[0].withColumnRenamed("value", "v0")
    for k, p in enumerate(parts[1:], 1):
        out = out.join(p.withColumnRenamed("value", f"v{k}"), "label", "full")
    return out


def concat_rows(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pivot(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Wide form of a few given columns, 0 where a cell is empty; not for all species."""
    return cells.groupBy("row").pivot("col", columns).agg(F.sum("value")).na.fill(0)


def describe(cells: DataFrame, label: str | None = None, axis: int = 0) -> DataFrame:
    """Statistics of one region or species, or over all without a label."""
    return all_stats(cells, axis) if label is None else one_stats(cells, axis).where(F.col("label") == label)


#: Rows of a matrix that lie in one block of files.
ROW_BLOCK = 4096


def encoded(cells: DataFrame) -> dict[str, DataFrame]:
    """Tables of a matrix: rows and cols (id, label), ids dense from 0 in the order of labels, and cells (row_id, col_id, value, block of rows).

    Ids come from ranges of the labels, so no task sees all of them.
    """
    from .spatial import ranked

    rows, cols = (ranked(cells.select(F.col(a).alias("label")).distinct(), "label").select(F.col("rank").alias("id"), "label") for a in AXES.values())
    of_rows, of_cols = (t.select(F.col("id").alias(f"{a}_id"), F.col("label").alias(a)) for t, a in ((rows, "row"), (cols, "col")))
    ids = cells.join(of_rows, "row").join(of_cols, "col").select("row_id", "col_id", "value", F.floor(F.col("row_id") / ROW_BLOCK).cast("int").alias("block"))
    return {"rows": rows, "cols": cols, "cells": ids}


def decoded(tables: dict[str, DataFrame]) -> DataFrame:
    """Cells (row, col, value, row_id, col_id) of the tables of ``encoded``; a cell without a label is an error."""
    out = tables["cells"]
    for axis in AXES.values():
        labels = tables[f"{axis}s"].select(F.col("id").alias(f"{axis}_id"), F.col("label").alias("_label"))
        out = out.join(labels, f"{axis}_id", "left")
        wrong = F.raise_error(F.concat(F.lit(f"no label of {axis} "), F.col(f"{axis}_id").cast("string")))
        out = out.withColumn(axis, F.when(F.col("_label").isNull(), wrong).otherwise(F.col("_label"))).drop("_label")
    return out.select("row", "col", "value", "row_id", "col_id")


def consistency(stacked: DataFrame, row: str, col: str, value: str, least: int) -> DataFrame:
    """(rule, label, expected, found) where matrix, list, summary, filtered matrix and presence disagree; empty if all is well."""
    from . import diversity

    cells = build(stacked, row, col, value)
    kept = stacked.where(F.col(row).isNotNull() & F.col(col).isNotNull())

    def differ(rule: str, a: DataFrame, b: DataFrame) -> DataFrame:
        j = a.toDF("label", "expected").join(b.toDF("label", "found"), "label", "full")
        return j.where(~F.col("expected").eqNullSafe(F.col("found"))).select(F.lit(rule).alias("rule"), F.col("label").cast("string").alias("label"), F.col("expected").cast("long").alias("expected"), F.col("found").cast("long").alias("found"))

    checks = [
        differ("list_row_total", kept.groupBy(row).agg(F.sum(value)), axis_totals(cells, 0)),
        differ("list_col_total", kept.groupBy(col).agg(F.sum(value)), axis_totals(cells, 1)),
        differ("summary_total", axis_totals(cells, 1), summary(cells, 0).select("label", "total")),
        differ("summary_count", axis_counts(cells, 0), summary(cells, 1).select("label", "count")),
        differ("presence_alpha", axis_counts(keep_between(cells, least), 0), diversity.alpha(diversity.presence(cells, least))),
    ]
    return concat_rows(*checks)


def presence_of(column: Column, least: int, most: int) -> Column:
    """1 where least < x <= most, else 0."""
    return ((column > least) & (column <= most)).cast("int")
