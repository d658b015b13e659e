"""Pair counts by tiles against plain sets."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from wildgrid.operators import diversity as D
from wildgrid.operators import tiles


@pytest.mark.parametrize("sizes", [{}, {"block": 3}, {"block": 4, "sites": 5}, {"block": 1, "sites": 1}])
def test_pairs_are_those_of_sets(spark, sizes):
    rnd = random.Random(3)
    have = sorted({(f"s{rnd.randrange(12)}", f"p{rnd.choice('abcéz')}{rnd.randrange(5)}") for _ in range(90)} | {("rich", f"q{k}") for k in range(20)} | {(f"s{k}", "everywhere") for k in range(12)})
    pam = spark.createDataFrame(have, "site string, species string").repartition(5)
    for of, on in (("species", 0), ("site", 1)):
        at: dict = {}
        for row in have:
            at.setdefault(row[1 - on], set()).add(row[on])
        total = len({row[on] for row in have})
        pairs = {(i, j): len(at[i] & at[j]) for i, j in itertools.combinations(sorted(at), 2)}
        assert {(r.i, r.j): r.n for r in tiles.shared(pam, of, **sizes).collect()} == {p: n for p, n in pairs.items() if n}
        sums = tiles.overlap_sums(pam, of, **sizes).agg(F.sum("squares"), F.sum("weighted")).first()
        assert tuple(sums) == (sum(n * n for n in pairs.values()), sum(n * (len(at[i]) + len(at[j])) for (i, j), n in pairs.items()))
        whole = {(r.i, r.j): r.sigma for r in tiles.covariances(pam, of, **sizes).collect()}
        pairs |= {(i, i): len(at[i]) for i in at}
        assert len(whole) == len(at) * (len(at) + 1) // 2
        assert whole == {(i, j): pytest.approx(n / total - len(at[i]) / total * (len(at[j]) / total)) for (i, j), n in pairs.items()}


def test_a_rich_site_is_spread_over_tasks(spark):
    """100,000 species at one site: 4,851 tiles, of which no task has many, and the score is that of the closed form."""
    n = 100_000
    rich = spark.range(n).select(F.lit("a").alias("site"), F.concat(F.lit("p"), "id").alias("species"))
    some = spark.range(0, n, 1000).select(F.lit("b").alias("site"), F.concat(F.lit("p"), "id").alias("species"))
    pam = rich.unionByName(some)
    found = tiles.Tiles(pam)
    parts = found._pairs().repartition(16, "bi", "bj", "salt").groupBy(F.spark_partition_id()).agg(F.count("*").alias("tiles"), F.max(F.size("a")).alias("longest")).collect()
    blocks = found.blocks
    assert blocks > 90 and sum(r.tiles for r in parts) >= blocks * (blocks + 1) // 2 and max(r.tiles for r in parts) < 800 and max(r.longest for r in parts) < 1.3 * tiles.BLOCK
    # only the pairs of a species of one site with one of both differ in nothing; every pair shares site a
    assert D.c_score(pam).first()[0] == 0


def test_no_sites(spark):
    none = spark.createDataFrame([], "site string, species string")
    assert tiles.shared(none).count() == 0 and tiles.covariances(none).count() == 0 and D.c_score(none).first()[0] is None
