"""Invariants and edge cases of the operators that the SQL comparison doesn't reach."""

import itertools
import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from wildgrid.functions import geometry as G
from wildgrid.functions import text as X
from wildgrid.operators import diversity as D
from wildgrid.operators import matrix as M
from wildgrid.operators import records, register, spatial
from wildgrid.sources import io


def test_irregular_polygons_match_a_plain_test(spark):
    rnd = random.Random(4)
    rings = [[(rnd.uniform(-9, 9), rnd.uniform(-9, 9)) for _ in range(rnd.randint(3, 9))] for _ in range(12)]
    points = [(i, rnd.uniform(-10, 10), rnd.uniform(-10, 10)) for i in range(300)]
    layer = spark.createDataFrame([(k, [[{"x": x, "y": y} for x, y in r]]) for k, r in enumerate(rings)], "fid int, rings array<array<struct<x:double,y:double>>>").withColumn("edges", G.edges(F.col("rings")))

    def inside(r, x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]):
            odd ^= (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
        return odd

    p = spark.createDataFrame(points, "gbifid int, lon double, lat double")
    want = sorted((i, k) for i, x, y in points for k, r in enumerate(rings) if inside(r, x, y))
    assert sorted(tuple(r) for r in spatial.spatial_join(p, layer).select("gbifid", "fid").collect()) == want
    assert sorted(tuple(r) for r in spatial.theta_filter(p, layer, G.contains(F.col("edges"), F.col("lon"), F.col("lat"))).select("gbifid", "fid").collect()) == want


def test_clipped_polygons_match_whole_ones(spark):
    """Long rings over many small cells: containment and nearest distance as with all edges."""
    rnd = random.Random(8)
    rings = [[(c + rnd.uniform(2, 6) * math.cos(2 * math.pi * i / n), rnd.uniform(2, 6) * math.sin(2 * math.pi * i / n)) for i in range(n)] for c, n in ((-4, 3), (0, 40), (5, 150))]
    rings.append([(-6.0, -6.0), (6.0, -6.0), (6.0, 6.0), (-6.0, 6.0)])  # edges on the borders of cells
    spots = [(x / 2, y / 2) for x in range(-14, 15, 4) for y in range(-14, 15, 4)] + [(rnd.uniform(-13, 13), rnd.uniform(-9, 9)) for _ in range(400)]
    layer = spark.createDataFrame([(k, f"n{k}", [[{"x": x, "y": y} for x, y in r]]) for k, r in enumerate(rings)], "fid int, name string, rings array<array<struct<x:double,y:double>>>")
    layer = layer.withColumn("edges", G.edges(F.col("rings")))
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "gbifid int, lon double, lat double")

    def sides(r):
        return list(zip(r, r[1:] + r[:1]))

    def inside(r, x, y):
        return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for (x1, y1), (x2, y2) in sides(r)) % 2 == 1

    def apart(r, x, y):
        def to(x1, y1, x2, y2):
            dx, dy = x2 - x1, y2 - y1
            u = min(1, max(0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
            return math.hypot(x - x1 - u * dx, y - y1 - u * dy)

        return 0.0 if inside(r, x, y) else min(to(*a, *b) for a, b in sides(r))

    want = sorted((i, k, f"n{k}") for i, (x, y) in enumerate(spots) for k, r in enumerate(rings) if inside(r, x, y))
    for cell in (0.5, 2.5, 40.0):
        assert sorted(tuple(r) for r in spatial.spatial_join(p, layer, "name", cell=cell).select("gbifid", "fid", "name").collect()) == want
        found = {r.gbifid: (r.fid, r.distance) for r in spatial.nearest_polygon(p, layer, "gbifid", 1.3, cell).collect()}
        for i, (x, y) in enumerate(spots):
            d, k = min((apart(r, x, y), k) for k, r in enumerate(rings))
            assert (i in found) == (d <= 1.3) and (i not in found or found[i] == (k, pytest.approx(d)))
    clipped = G.clipped_cover(layer, 0.5).agg(F.max(F.size("edges")), F.count(F.when((F.size("edges") == 0) & (F.col("crossed") == 1), 1))).first()
    assert clipped[0] < 100 and clipped[1] > 100


def test_holes_and_missing_places(spark):
    outer, hole = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(3.0, 3.0), (7.0, 3.0), (7.0, 7.0), (3.0, 7.0)]
    layer = spark.createDataFrame([(1, [[{"x": x, "y": y} for x, y in r] for r in (outer, hole)])], "fid int, rings array<array<struct<x:double,y:double>>>").withColumn("edges", G.edges(F.col("rings")))
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, None, 1.0), (4, 50.0, 50.0)], "gbifid int, lon double, lat double")
    assert [r.gbifid for r in spatial.spatial_join(p, layer).collect()] == [1]


def test_joins_use_no_nested_loop(spark):
    from wildgrid.plans.views import domain, layer

    d = "/root/testdata/sf0.001"
    found = spatial.spatial_join(domain(spark, d, "occ").select("gbifid", "lon", "lat"), layer(spark, d, "poly"), "name")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_matrix_filter_needs_bounds(spark):
    cells = spark.createDataFrame([("a", "x", 1)], "row string, col string, value long")
    with pytest.raises(ValueError):
        M.keep_between(cells)
    with pytest.raises(ValueError):
        M.keep_between(cells, 0)
    with pytest.raises(KeyError):
        M.vector(cells, "none")


def test_diversity_against_definitions(spark):
    rnd = random.Random(2)
    have = sorted({(f"s{rnd.randint(0, 7)}", f"p{rnd.randint(0, 9)}") for _ in range(45)})
    pam = spark.createDataFrame(have, "site string, species string")
    sites, species = sorted({s for s, _ in have}), sorted({p for _, p in have})
    at = {p: {s for s, q in have if q == p} for p in species}
    n, m = len(species), len(sites)
    score = 2 * sum((len(at[i]) - len(at[i] & at[j])) * (len(at[j]) - len(at[i] & at[j])) for i, j in itertools.combinations(species, 2)) / (n * (n - 1))
    assert D.c_score(pam).first()[0] == pytest.approx(score)
    one = D.diversity_stats(pam).first()
    p = {q: len(at[q]) / m for q in species}
    cov = sum(len(at[i] & at[j]) / m - p[i] * p[j] for i in species for j in species)
    assert one.schluter_species == pytest.approx(cov / sum(x - x * x for x in p.values()))
    with pytest.raises(Exception, match="0 or 1"):
        D.checked(spark.createDataFrame([("a", "b", 2)], "site string, species string, value int")).collect()


def test_bundle_and_tables_round_trip(spark, tmp_path):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    io.write_bundle({"t": df}, str(tmp_path / "b"), {"k": 1})
    tables, meta = io.read_bundle(spark, str(tmp_path / "b"))
    assert meta["k"] == 1 and tables["t"].exceptAll(df).count() == 0
    assert io.write_table(df, "bundle_table").count() == 5
    io.drop_table(spark, "bundle_table")
    assert not spark.catalog.tableExists("bundle_table")
    with pytest.raises(Exception):
        io.write_csv(df, str(tmp_path / "b"), ["v"])
    (tmp_path / "empty").mkdir()
    assert io.parquet_folder(spark, str(tmp_path / "empty")) is None


def test_parts_equal_whole(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "id int, k int")
    chunks = spatial.chunk_bounds(df, 7, "id").groupBy("chunk").count().orderBy("chunk").collect()
    assert sum(r["count"] for r in chunks) == 100 and {r["count"] for r in chunks[:-1]} == {15}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "row string, col string, value long")
    assert M.one_stats(none).count() == 0 and D.c_score(D.presence(none)).first()[0] is None
    assert M.all_stats(none).count() == 1
    raw = spark.createDataFrame([], "id int, a string, b string")
    assert records.priority_key(raw, ["a", "b"], "id").count() == 0


def test_month_wraps_at_january(spark):
    d = spark.sql("select date'2024-01-15' as d")
    assert d.select(X.month_string(F.col("d"), 1)).first()[0] == "2023_12_01"


def test_broken_matrices_are_found(spark, monkeypatch):
    """Each check of consistency finds what it is for: a cell lost, a total changed, presence by another bound."""
    from wildgrid.operators import diversity, matrix

    rows = [("a", "x", 5), ("a", "y", 2), ("b", "x", 1), ("b", "z", 7), ("c", "y", 3)]
    stacked = spark.createDataFrame(rows, "site string, species string, n long")
    check = lambda: {(r.rule, r.label, r.expected, r.found) for r in matrix.consistency(stacked, "site", "species", "n", 2).collect()}
    assert check() == set()
    build = matrix.build
    with monkeypatch.context() as m:
        m.setattr(matrix, "build", lambda *a: build(*a).where("not (row = 'b' and col = 'z')"))
        assert check() == {("list_row_total", "b", 8, 1), ("list_col_total", "z", 7, None)}
    with monkeypatch.context() as m:
        summary = matrix.summary
        m.setattr(matrix, "summary", lambda cells, axis=0: summary(cells.where("col <> 'y' or row <> 'c'"), axis))
        assert check() == {("summary_total", "y", 5, 2), ("summary_count", "c", 1, None)}
    with monkeypatch.context() as m:
        presence = diversity.presence
        m.setattr(diversity, "presence", lambda cells, least, *a: presence(cells, least + 1, *a))
        assert check() == {("presence_alpha", "a", 2, 1)}


def test_dependent_fields(spark):
    """Every rule, among them one coordinate without the other and a centroid without coordinates."""
    from wildgrid.operators import quality

    cols = "id int, tsn string, accepted_name string, accepted_tsn string, lon string, lat string, centroid string, country string, thumb string, media string"
    rows = [
        (1, "T", None, "A", None, None, None, "ZZ", None, None), (2, None, None, None, "5", "", None, "ZZ", None, None), (3, None, None, None, None, "7", "county", "ZZ", None, None),
        (4, None, None, None, "", None, "county", "US", None, None), (5, None, None, None, "3", "4", "county", "US", None, None), (6, None, None, None, "-3", "4", "county", "CA", "t", None), (7, "T", "N", "A", "-3", "4", None, "US", "t", "m"),
    ]
    found = {(r.record_id, r.rule, r.value) for r in quality.dependent(spark.createDataFrame(rows, cols), "id").collect()}
    assert found == {(1, "tsn", "T"), (2, "one_coordinate", "5"), (3, "one_coordinate", "7"), (4, "centroid", "county"), (5, "sign", "3 4"), (6, "thumb", "t")}


def test_runs_and_ranks_do_not_depend_on_partitions(spark):
    import random

    from wildgrid.operators import matrix, records

    rnd = random.Random(3)
    rows = [(p, i, rnd.randrange(5)) for p, n in (("hot", 300), ("b", 20), (None, 9)) for i in range(n)]
    want, last = {}, {}
    for p, i, k in rows:
        run, before = last.get(p, (0, k))
        last[p] = run + (k < before), k
        want[p, i] = last[p][0]
    df = spark.createDataFrame(rows, "part string, at int, k int")
    assert {(r.part, r.at): r.run for r in records.sorted_runs(df, "k", "at", "part").collect()} == want
    table = spark.createDataFrame([(str(i), v) for i, v in enumerate([9, 9, 7, 5, 5, 5, 5, 1, None])], "label string, v long")
    for largest, n, expected in ((True, 4, [1, 1, 3, 4, 4, 4, 4]), (False, 2, [1, 2, 2, 2, 2]), (True, 50, [1, 1, 3, 4, 4, 4, 4, 8])):
        assert sorted(r["rank"] for r in matrix.rank(table, "v", largest, n).collect()) == expected
    assert matrix.rank(table.limit(0), "v").count() == 0


def test_annotated_table_follows_its_files(spark, tmp_path):
    """One table for a folder, written anew when a file changes or the table is gone."""
    import shutil

    from wildgrid.plans import views

    for name in ("orders", "customer", "nation", "part"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path)
    first = views.annotated_table(spark, str(tmp_path))
    assert views.annotated_table(spark, str(tmp_path)).inputFiles() == first.inputFiles()
    n = first.count()
    assert n == views.annotated(spark, str(tmp_path)).count() > 0
    shutil.rmtree(first.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
    assert views.annotated_table(spark, str(tmp_path)).count() == n
    duckdb.sql(f"copy (select * from '/root/testdata/sf0.001/orders.parquet' where o_orderkey % 2 = 0) to '{tmp_path}/orders.parquet'")
    assert 0 < views.annotated_table(spark, str(tmp_path)).count() < n


def test_a_record_meets_one_register_row_for_each_key(spark):
    """Many lines of one region and taxon: the last one's assessment, without a row for each record and line."""
    rnd = random.Random(2)
    lines = [(rnd.choice(["AK", "HI"]), str(rnd.randint(0, 3)), i, f"A{i % 7}") for i in range(400)]
    rows = [(i, rnd.choice(["AK", "HI", None]), rnd.sample(range(6), rnd.randint(0, 3))) for i in range(60)]
    r = spark.createDataFrame(lines, "locality string, gbif_res_taxonkey string, occurrenceid long, degreeofestablishment string")
    found = register.assess_keys(spark.createDataFrame(rows, "id long, riis_region string, keys array<int>"), r, "id")
    assert "Aggregate [locality" in found._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for i, region, keys in rows:
        met = [(pos, o, a.lower()) for pos, k in enumerate(keys) for place, key, o, a in lines if place == region and int(key) == k]
        want[i] = max(met)[2] if met else register.NATIVE
    assert {x["id"]: x["assessment"] for x in found.collect()} == want


def test_job_annotate_records_reduces_the_register_first(spark, monkeypatch):
    from wildgrid.plans import registry

    plans, write = [], io.write_parquet

    def seen(df, path, *a, **k):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, path, *a, **k)

    monkeypatch.setattr(io, "write_parquet", seen)
    registry.queries()["job_annotate_records"](spark, "/root/testdata/sf0.001")
    assert any("Aggregate [locality" in p for p in plans)


def test_job_annotate_records_groups_nothing_by_record(spark, monkeypatch):
    """Records stay one row from the scan to the table and to the report: no aggregate by id, no join by id."""
    from wildgrid.plans import registry

    plans, write = [], io.write_parquet

    def seen(df, path, *a, **k):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, path, *a, **k)

    monkeypatch.setattr(io, "write_parquet", seen)
    found = registry.queries()["job_annotate_records"](spark, "/root/testdata/sf0.001")
    plans.append(found._jdf.queryExecution().optimizedPlan().toString())
    assert not re.search(r"Aggregate \[gbifid|Join .*gbifid", "\n".join(plans))


def test_records_look_up_each_place_of_their_keys(spark):
    """With a known number of keys the same as without, also for null regions, no keys and null keys; more keys are an error."""
    rnd = random.Random(5)
    lines = [(rnd.choice(["AK", "HI"]), rnd.choice(["0", "1", "2", "x", None]), i, f"A{i % 7}") for i in range(60)]
    rows = [(i, rnd.choice(["AK", "HI", "L48", None]), rnd.choice([None, [], [None, 1]]) if i % 9 == 0 else rnd.sample(range(5), rnd.randint(0, 3))) for i in range(80)]
    r = spark.createDataFrame(lines, "locality string, gbif_res_taxonkey string, occurrenceid long, degreeofestablishment string")
    df = spark.createDataFrame(rows, "id long, riis_region string, keys array<int>")
    got = register.assess_keys(df, r, "id", most=3)
    assert {tuple(map(str, x)) for x in got.collect()} == {tuple(map(str, x)) for x in register.assess_keys(df, r, "id").select(*got.columns).collect()}
    with pytest.raises(Exception, match="more than 2 keys"):
        register.assess_keys(df, r, "id", most=2).collect()


def test_the_nearest_polygon_comes_along_with_its_attributes(spark):
    """Points keep their columns and stay one row each, with or without a polygon near."""
    def ring(x, y):
        return [(x, y, x + 1.0, y), (x + 1.0, y, x + 1.0, y + 1.0), (x + 1.0, y + 1.0, x, y + 1.0), (x, y + 1.0, x, y)]

    layer = spark.createDataFrame([(2, "b", ring(0.0, 0.0)), (1, "a", ring(2.0, 0.0))], "fid long, code string, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    points = [(1, 0.5, 0.5), (1, 1.5, 0.5), (3, 1.25, 0.5), (4, 9.0, 9.0), (5, None, 1.0), (6, 3.5, 0.5)]
    found = spatial.with_nearest(spark.createDataFrame(points, "id long, lon double, lat double"), layer, 1.0, "code", cell=0.7).collect()
    want = {(1, 0.5): (0.0, 2, "b"), (1, 1.5): (0.5, 1, "a"), (3, 1.25): (0.25, 2, "b"), (4, 9.0): None, (5, None): None, (6, 3.5): (0.5, 1, "a")}
    assert len(found) == len(points) and {(x.id, x.lon): x.nearest and tuple(x.nearest) for x in found} == want


def test_pairs_of_one_name_are_dealt_over_tasks(spark, monkeypatch):
    """All pairs of lines as by brute force, each once, and of a name that most lines have no task has more than a part."""
    monkeypatch.setattr(register, "PAIRS", 1000)
    rnd = random.Random(8)
    rows = [(rnd.randrange(500) if k % 50 else None, "hot" if k % 6 else rnd.choice(["a", "b", None, f"n{k}"]), rnd.choice([1, 2, None]), rnd.choice(["AK", "HI", None]), rnd.choice("xyz")) for k in range(600)]
    found = register.duplicates(spark.createDataFrame(rows, "line long, name string, key long, locality string, assessment string"), block=50)
    got = sorted(tuple(r) for r in found.collect())
    want = []
    for a, b in itertools.product(rows, rows):
        if None not in (a[0], b[0], a[1]) and a[1] == b[1] and a[0] < b[0]:
            key, place, status = (a[i] == b[i] for i in (2, 3, 4))
            want.append((a[0], b[0], key, place, place and status, key and place and status))
    assert got == sorted(want)
    share = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().agg(F.max("count")).first()[0]
    assert share < len(want) / 5
    assert register.duplicates(spark.createDataFrame([], "line long, name string, key long, locality string, assessment string")).count() == 0
