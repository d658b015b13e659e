"""op4, op6 and the pipeline: against brute force on small tables."""

import random
import re
from math import comb

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wildgrid.llm import jaccard, mixing
from wildgrid.llm.common import written

LOW = str.maketrans(jaccard.UPPER, jaccard.LOWER)


def sets(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def spark_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute(rows, k, percent):
    """doc_id -> (shingles, smallest reachable id); rows of one id are one document."""
    s = [(i, sets(t, k)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(s):
        for j, b in s[x + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return sorted((i, len(a), find(i)) for i, a in s)


def corpus(seed, n=90):
    """Bases, copies with a few words changed, chains, common passages, short ones."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(25)]
    rows, bases = [], []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.35 or not bases:
            w = [word() for _ in range(rnd.choice([1, 2, 4, 12, 60, 150, 400]))]
            bases.append(w)
        else:
            w = list(rnd.choice(bases))
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6])):
                w[rnd.randrange(len(w))] = word()
            if kind > 0.7:
                bases.append(w)
        if rnd.random() < 0.3:
            w = w[: len(w) // 2] + passage + w[len(w) // 2 :]
        rows.append((i * 3 + 1, " ".join(w).upper() if rnd.random() < 0.2 else "\n".join(w)))
    return rows


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, k, percent):
    rows = corpus(k) + [(500, None), (501, ""), (502, " \t"), (503, "one two"), (504, "ONE two"), (505, "one two three")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component string")
    found = sorted(tuple(r) for r in jaccard.near_components(df, k, percent).collect())
    assert found == brute(rows, k, percent)


def test_large_group_around_a_base(spark):
    """Copies with edits of their own: many of them are linked to the base alone."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(f"z{i}" for i in range(120)))]
    for i in range(1, 150):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 2, 3])):
            w[rnd.randrange(120)] = f"e{i}_{rnd.random()}"
        rows.append((i, " ".join(w)))
    rows.append((150, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard.near_components(df, 3, 90).collect()) == brute(rows, 3, 90)


def test_pigeonhole_never_misses():
    """Each similar pair meets in the segments that a probe may not leave out, whatever it leaves out."""
    rnd = random.Random(3)
    import numpy as np

    for percent in (80, 90):
        bands = jaccard.Bands(percent)
        for _ in range(150):
            n = rnd.randint(10, 300)
            a = np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64))
            b = set(a.tolist())
            for _ in range(rnd.randint(0, n // 6)):
                b.discard(rnd.choice(sorted(b))) if rnd.random() < 0.5 else b.add(rnd.getrandbits(64))
            b = np.array(sorted(b), np.uint64)
            r, s = (a, b) if len(a) >= len(b) else (b, a)
            same = len(np.intersect1d(r, s))
            if 100 * same < percent * (len(r) + len(s) - same) or same == len(r) == len(s):
                continue
            rows = {}
            for x, y in zip(*jaccard.signatures(s, bands)):
                if y & jaccard.INDEX:
                    rows.setdefault(int(x), []).append(int(y))
            spare, met = None, {}
            for x, y in zip(*jaccard.signatures(r, bands)):
                band, seg = int(y) >> 23 & 255, int(y) >> 31
                if band == bands.of(len(s)):
                    spare = int(y) >> 3 & (1 << 20) - 1
                    if any(not (int(y) & z & jaccard.LESS) for z in rows.get(int(x), [])):
                        met[seg] = 2 if seg < jaccard.NEIGHBOURS else 1
            assert sum(met.values()) > spare  # more than may be left out


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (102, 100), (7, 7)]
    found = {r.node: r.component for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 104))
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_rows_null_ids_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_components(none).count() == 0
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (5, "a b c d e f" * 40)]
    found = sorted(jaccard.near_components(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect(), key=str)
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (1, 1), (2, 1), (2, 1), (5, 5)]


def test_texts_of_one_id_are_one_document(spark):
    """Links of any text of an id are links of the document, on chains of ids and texts too."""
    a, b, c = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [(5, a), (5, b), (1, a), (9, b), (20, c), (21, c), (30, "x y z"), (31, ""), (31, None)]
    found = {r.doc_id: r.component_id for r in jaccard.near_components(spark_rows(spark, rows)).collect()}
    assert found == {5: 1, 1: 1, 9: 1, 20: 20, 21: 20, 30: 30, 31: 31}
    rnd = random.Random(4)
    rows = [(rnd.randrange(60), t) for _, t in corpus(11, 90)]
    found = sorted(tuple(r) for r in jaccard.near_components(spark_rows(spark, rows), 3, 90).collect())
    assert found == brute(rows, 3, 90)


# --- mixing -------------------------------------------------------------------------------


def levelled(sizes, weights=(5, 2, 1), cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        over = [s for s in free if left * w[s] / sum(w[x] for x in free) > cap * sizes[s]]
        if not over:
            return {**fixed, **{s: left * w[s] / sum(w[x] for x in free) for s in free}}
        fixed |= {s: cap * sizes[s] for s in over}


def mix_table(spark, seed=1, n=400):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["hot"] * 6 + ["b", "ä", None, "tiny"]) if i > 3 else "tiny", " ".join("w" * rnd.randint(1, 40))) for i in range(n)]
    rows += [(n, "b", None), (n + 1, "empty", ""), (n + 2, "hot", "x " * 20_000)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_targets_and_taken(spark):
    rows, df = mix_table(spark)
    found = mixing.placed(df, block_rows=16).collect()
    sizes, taken, target = {}, {}, {}
    for r in found:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert r.mix_size == words and len(r.mix_places) <= 3
        sizes[r.source] = sizes.get(r.source, 0) + words
        taken[r.source] = taken.get(r.source, 0) + words * len(r.mix_places)
        target[r.source] = r.mix_target
    want = levelled(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= max(20, 0.02 * want[s] if s != "hot" else 20_000)
    again = mixing.placed(df.repartition(7), block_rows=16).collect()
    key = lambda rs: sorted((r.doc_id, tuple(map(tuple, r.mix_places))) for r in rs)
    assert key(found) == key(again)


@pytest.mark.parametrize("block_rows", [16, 1024])
@pytest.mark.parametrize("large", [[60_000], [5_000] * 9])
def test_documents_that_do_not_fit_are_passed_over(spark, block_rows, large):
    """Wherever large ones lie in hash order, smaller ones behind them fill the target up."""
    rows = [(i, "a", n) for i, n in enumerate([*large, *[30] * 300, *[7] * 40, 0, 0])]
    rows += [(10_000 + i, "b", n) for i, n in enumerate([40_000, *[100] * 150])]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long").withColumn("text", F.col("doc_id").cast("string"))
    for weights in ((1, 9), (7, 1)):
        found = mixing.placed(df, F.col("n"), weights=weights, block_rows=block_rows).collect()
        assert len(found) == len(rows) and not any(r.mix_places for r in found if r.n == 0 and r.mix_target == 0)
        for source in "ab":
            own = [r for r in found if r.source == source]
            taken, target, whole = sum(r.n * len(r.mix_places) for r in own), own[0].mix_target, int(own[0].mix_target // own[0].mix_source_size)
            left = [r.n for r in own if r.n and len(r.mix_places) == whole]
            assert {len(r.mix_places) for r in own if r.n} <= {whole, whole + 1}
            assert abs(taken - target) <= min(left or [max(r.n for r in own)]) / 2 + 1e-6


def brute_last_pass(rows, blocks, targets, shards, chance):
    """Keys that the last pass takes: by loops over (source number, block, key, size) and the shard of each block."""
    out = set()
    for number, (rest, n_blocks) in targets.items():
        mine = [r for r in rows if r[0] == number]
        small = lambda r: r[3] <= rest / min(shards, n_blocks)  # noqa: B023, E731
        words, limit = sum(r[3] for r in mine if small(r)), rest / min(shards, n_blocks)
        large = sorted((r for r in mine if not small(r) and r[3] <= rest), key=lambda r: r[2])
        asked = rest * sum(r[3] for r in large) / max(1, words + sum(r[3] for r in large))
        total = 0
        for r in large:
            if total + r[3] <= rest and (total + chance[number] * r[3] < asked or total < rest - words):
                out.add(r[2])
            total += r[3]
        rest -= sum(r[3] for r in large if r[2] in out)
        left, small = rest, lambda r: r[3] <= limit  # noqa: B023, E731
        for shard in {blocks[r[:2]] for r in mine}:
            own = [r for r in mine if blocks[r[:2]][:1] == shard[:1] and small(r)]
            share = rest * sum(r[3] for r in own) / words if words else 0
            total = 0
            for r in sorted(own, key=lambda r: (blocks[r[:2]][1], r[2])):
                total += r[3]
                if total <= share + 1e-9 and r[2] not in out:
                    out.add(r[2])
                    left -= r[3]
        for r in sorted((r for r in mine if r[2] not in out and r[3]), key=lambda r: (r[3], r[1], r[2])):
            if r[3] > left:
                if r[3] - left < left:
                    out.add(r[2])
                break
            out.add(r[2])
            left -= r[3]
    return out


def test_last_pass_matches_brute_force(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.choice("aaab") if i > 40 else "c", rnd.choice([1, 3, 20, 50, 200, 900])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long").withColumn("text", F.col("doc_id").cast("string"))
    taken = {}
    for shards, seed in ((4, 7), (4, 8), (1, 7)):
        slim = mixing._rows(df, F.col("n"), "source", seed).select("source", "mix_key", "mix_size", "doc_id")
        targets, blocks = mixing.plan(slim.select("source", "mix_key", "mix_size"), (5, 2, 1), 3.0, shards, 8, seed)
        order = {(r.mix_number, r.mix_block): (r.last_shard, r.before) for r in blocks.collect()}
        placed = mixing.blocked(slim, targets, "source").collect()
        chance = {r.mix_number: r.u for r in targets.select("mix_number", mixing._chance(F.lit(seed + 4), "mix_number").alias("u")).collect()}
        want = brute_last_pass([(r.mix_number, r.mix_block, r.mix_key, r.mix_size) for r in placed], order, {r.mix_number: (r.mix_rest, r.mix_blocks) for r in targets.collect()}, shards, chance)
        whole = {r.doc_id: r.mix_whole for r in placed}
        found = {r.doc_id: len(r.mix_places) for r in mixing.placed(df, F.col("n"), block_rows=8, shards=shards, seed=seed).collect()}
        assert found == {r.doc_id: whole[r.doc_id] + (r.mix_key in want) for r in placed}
        taken[shards, seed] = found
    assert taken[4, 7] != taken[4, 8] and taken[4, 7] != taken[1, 7]  # seed and tree decide


def test_large_documents_take_part(spark):
    """One of 1,000 words beside two hundred of 10: a target of 2,500 is met whatever the seed."""
    rows = [(0, "b", 1000), *[(k, "b", 10) for k in range(1, 201)], (1000, "a", 2000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long").withColumn("text", F.col("doc_id").cast("string"))
    for seed in range(4):
        found = mixing.placed(df, F.col("n"), weights=(1, 1), seed=seed).where("source = 'b'").collect()
        assert found[0].mix_target == 2500 and sum(r.n * len(r.mix_places) for r in found) == 2500


def test_no_size_is_kept_out(spark):
    """Over seeds, documents of every size are taken at about the rate of target to size, and the target is met each time."""
    sizes = {1: [600] * 3, 2: [150] * 20, 3: [5] * 1000}  # 9,800 words
    rows = [(1000 * k + i, "b", n) for k, own in sizes.items() for i, n in enumerate(own)] + [(0, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long").withColumn("text", F.col("doc_id").cast("string"))
    seeds, rates, target = 10, dict.fromkeys(sizes, 0.0), 0
    for seed in range(seeds):
        d = df.withColumn("n", F.when(F.col("source") == "a", 9800 * 2).otherwise(F.col("n")))
        found = mixing.placed(d, F.col("n"), weights=(5, 1), seed=seed).where("source = 'b'").collect()
        target = found[0].mix_target
        assert abs(sum(r.n * len(r.mix_places) for r in found) - target) <= 5
        for k in sizes:
            rates[k] += sum(len(r.mix_places) for r in found if r.doc_id // 1000 == k) / len(sizes[k]) / seeds
    assert 0.3 < target / 9800 < 0.7
    for k, rate in rates.items():
        assert abs(rate - target / 9800) < (0.3 if k == 1 else 0.15), (k, rate, target / 9800)


def test_leaves_add_up_and_are_fair(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 25), (2, 0), (3, 7)], "number int, tickets long")
    leaves = mixing.split_tickets(quotas, 8, 3).collect()
    by = lambda k: {x: sum(r.quota for r in leaves if r[k] == x) for x in {r[k] for r in leaves}}
    assert by("number") == {0: 40, 1: 25, 2: 0, 3: 7} and set(by("shard").values()) == {9}
    left = [sum(r.quota for r in mixing.split_tickets(quotas, 2, s).collect() if r.shard == 0 and r.number == 0) for s in range(12)]
    assert len(set(left)) > 3 and 15 < sum(left) / len(left) < 25  # 20 on average
    with pytest.raises(ValueError):
        mixing.split_tickets(quotas, 3, 1)


def test_hypergeometric_quantiles(spark):
    """Against the distribution by binomial coefficients, and large numbers by mean and range."""
    cases = [(0, 0, 0), (1, 1, 1), (10, 4, 5), (10, 10, 3), (10, 0, 7), (50, 20, 49), (200, 77, 100)]
    us = [0.0, 0.01, 0.3, 0.52, 0.77, 0.999]
    rows = [(u, *c) for c in cases for u in us]
    draw = mixing.hypergeometric(F.col("u"), F.col("n"), F.col("k"), F.col("d"))
    found = spark.createDataFrame(rows, "u double, n long, k long, d long").select("*", draw.alias("x")).collect()
    for r in found:
        cumulative, x = 0, max(0, r.d - (r.n - r.k))
        while True:
            cumulative += comb(r.k, x) * comb(r.n - r.k, r.d - x)
            if cumulative > r.u * comb(r.n, r.d):
                break
            x += 1
        assert r.x == x, r
    large = spark.range(40).select(((F.col("id") + 0.5) / 40).alias("u"), F.lit(20_000_000).alias("n"), F.lit(6_000_000).alias("k"), F.lit(10_000_000).alias("d")).select(draw.alias("x")).collect()
    assert abs(sum(r.x for r in large) / 40 - 3_000_000) < 100 and len({r.x for r in large}) == 40


def test_shards_hold_the_mix(spark, tmp_path):
    _, df = mix_table(spark, 2, 150)
    mix = mixing.mixed(df, block_rows=8, shards=4)
    mixing.write_shards(mix, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == mix.count() and back.select("mix_shard").distinct().count() == 4


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.placed(none).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert [len(r.mix_places) for r in mixing.placed(blank).collect()] == [0, 0]
    with pytest.raises(ValueError):
        mixing.placed(none.withColumn("mix_size", F.lit(1)))


# --- pipeline -------------------------------------------------------------------------------


def test_stages_one_by_one(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "mixture", "piece_ids"]
    after = {}
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        given = rows
        rows = corpus_pipeline.written(stage(spark, rows, d), "test-stage")
        after[name] = rows
        if name != "piece_ids":
            assert rows.columns == docs.columns
        if name == "language":
            letters = {r.doc_id for r in given.collect() if r.text and any(c.isalpha() for c in r.text)}
            assert {r.doc_id for r in rows.collect()} == letters
            noise = docs.limit(20).withColumn("text", F.sha2(F.col("text"), 256)).unionByName(docs)
            assert corpus_pipeline.language(spark, noise.withColumn("lang", F.when(F.length("text") != 64, F.col("lang"))), d).count() == rows.count()
        if name == "near_duplicates":
            groups = brute([(r.doc_id, r.text) for r in given.collect()], 5, 80)
            assert sorted(r.doc_id for r in rows.collect()) == sorted(i for i, _, c in groups if i == c)
        if name == "mixture":
            assert {r.doc_id for r in rows.collect()} <= {r.doc_id for r in given.collect()}
    assert after["piece_ids"].count() == after["mixture"].count() and after["piece_ids"].where("n_pieces is null").count() == 0


def test_no_label_vouches_for_its_own_text(spark):
    """Labelled noise goes as unlabelled noise does, with copies of it; labelled prose stays, in the language of few labels too."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rnd = random.Random(2)
    noise = ["".join(chr(rnd.randrange(33, 127)) for _ in range(4000)) for _ in range(2)]
    rows = [(900_000 + k, noise[k % 2], lang, "noise", 4000) for k, lang in enumerate(["en", "de", "en", None])]
    given = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.language(spark, given, "").collect()}
    assert not kept & {r[0] for r in rows}
    assert kept == {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    few = docs.where("lang is not null and text is not null").limit(1)
    assert corpus_pipeline.language(spark, few, "").count() == 1  # one half has no label


def test_stages_without_rows_and_with_odd_ones(spark):
    d = "/root/testdata/sf0.001"
    odd = spark.createDataFrame([(None, None, None, None, 0), (1, "", "en", "s", 0), (2, "hello there you", "en", None, 5), (2, "hello there you", "en", None, 5), (3, "x" * 200_000, "de", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    odd = odd.selectExpr("*", "1 as score", "2 as lang_pred", "3 as mix_size", "4 as mix_shard", "5 as component_id", "'r' as row", "'d' as doc")
    for docs in (odd.limit(0), odd):
        rows = docs
        for _, stage in corpus_pipeline.STAGES:
            rows = corpus_pipeline.written(stage(spark, rows, d), "test-odd")
        rows.count()


def test_no_text_is_lost_where_ids_repeat(spark):
    """Survivors are chosen by text: one row of each group of near-duplicate texts, whatever their ids."""
    a, b, c = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    schema = "doc_id long, text string, row string, doc string"

    def kept(rows):
        df = spark.createDataFrame([(i, t, "r", "d") for i, t in rows], schema)
        out = corpus_pipeline.near_duplicates(spark, df, "")
        assert out.columns == df.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    assert kept([(5, a), (5, b), (1, a), (9, b), (None, a), (2, c), (2, c), (2, None), (2, ""), (3, c), (None, "z")]) == [(1, a), (2, ""), (2, c), (2, None), (5, b), (None, "z")]
    rnd = random.Random(5)
    rows = [(rnd.choice([None, *range(20)]), t) for _, t in corpus(12, 60)]
    numbered = list(enumerate(t for _, t in rows))
    groups = {}
    for i, n, g in brute(numbered, 5, 80):
        groups.setdefault(g, []).append(rows[i])
    found = kept(rows)
    assert len(found) == len(groups)
    for members in groups.values():
        least = min((i is None, i or 0) for i, _ in members)
        assert any(r in found for r in members if (r[0] is None, r[0] or 0) == least)


def test_wide_rows_reach_python_in_small_batches(spark, monkeypatch):
    """Neither texts nor pairs of whole sets fill an Arrow batch of 10,000 rows; the session's own setting comes back."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, given = spark.conf.get(setting), []
    found = written(spark.range(1000).coalesce(1).mapInArrow(lambda batches: batches, "id long"), "batches", 100)
    assert found.count() == 1000 and spark.conf.get(setting) == before
    sizes = written(spark.range(1000).coalesce(1).mapInPandas(lambda frames: (f.head(1).assign(id=len(f)) for f in frames), "id long"), "sizes", 100)
    assert max(r.id for r in sizes.collect()) <= 100

    def seen(df, name, batch=None):
        given.append((name, batch))
        return written(df, name, batch)

    monkeypatch.setattr(jaccard, "written", seen)
    jaccard.near_components(spark_rows(spark, [(i, f"a b c d e f g h i {i}") for i in range(30)])).collect()
    wide = {"sets", "shared", "elements", "near", "links", "more-links"}
    assert wide <= {n for n, _ in given} and all(b == jaccard.BATCH for n, b in given if n in wide)
