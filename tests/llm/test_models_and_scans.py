"""op2, op7, op8, op9, op10: against brute force, hand-made cases and held-out rows."""

import itertools
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wildgrid.llm import ann, langid, licenses, transcripts, urls

TINY = "/root/testdata/sf0.001"

# --- urls -----------------------------------------------------------------------

URLS = [
    (1, "http://A.Example.COM/en/7?x", "a.example.com", "/en/7", "example.com/en/7", "allow"), (2, "https://example.net/de/81#f", "example.net", "/de/81", "example.net/de/8", "block"),
    (3, "x://net/de/", "net", "/de/", "net/de/", "allow"), (4, "http://notexample.com/en/70", "notexample.com", "/en/70", "com/en/", "block"), (5, "http://b.org?q=/es/", "b.org", "", None, None),
    (6, None, "", "", None, None), (7, "no scheme", "", "", None, None), (8, "http://", "", "", None, None), (9, "a://b://c/d", "b:", "//c/d", None, None), (10, "http://ÄÖ.org/es/", "ÄÖ.org", "/es/", "org/es/", "block"),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(r[0], r[1], "x") for r in URLS], "page_id long, url string, rules string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (99, 1), (5, None)], "page_id long, good int")
    with pytest.raises(ValueError):
        urls.judge(pages.withColumn("host", F.lit(1)), labels, urls.RULES)
    found = {r.page_id: r for r in urls.judge(pages.drop("rules"), labels, urls.RULES).collect()}
    for i, _, host, path, rule, verdict in URLS:
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict == (verdict or ("allow" if found[i].reputation >= urls.THRESHOLD else "block"))
    assert urls.judge(pages.drop("rules").limit(0), labels.limit(0), urls.RULES).count() == 0


def test_reputation_shrinks(spark):
    rows = [("a.good.com", 1)] * 60 + [("b.good.com", 1)] * 2 + [("c.bad.com", 0)] * 60 + [("d.bad.com", None)] + [("lone.org", 1)] + [("x.co.uk", 0), ("y.x.co.uk", 0)]
    r = {x.host: x for x in urls.host_reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert r["a.good.com"].bound > r["b.good.com"].bound > r["d.bad.com"].bound  # few labels, then none but the domain's
    assert 0 < r["lone.org"].mean < 1 and all(0 <= x.bound <= x.mean <= 1 for x in r.values())
    names = ["y.x.co.uk", "com", "a.b.com", "w.a.gov.mx:80", "me@b.com:8080", "10.0.0.1:80", "[::1]:443", "a.de.mytop", ""]
    d, s = urls.registered(F.col("h"), ("de.mytop",))
    found = [tuple(x) for x in spark.createDataFrame([(n,) for n in names], "h string").select(d, s).collect()]
    assert found == [
        ("x.co.uk", "co.uk"), ("com", "com"), ("b.com", "com"), ("a.gov.mx", "gov.mx"), ("b.com", "com"), ("10.0.0.1", "10.0.0.1"), ("[::1]", "[::1]"), ("a.de.mytop", "de.mytop"), ("", ""),
    ]


def test_hot_hosts_and_repeated_pages(spark):
    # one host has most pages, 1,200 hosts have one each and so too few to be broadcast
    rows = [(i, "http://hot.com/en/") for i in range(3000)] + [(3000 + i, f"http://h{i}.org/a") for i in range(1200)] + [(1, "http://hot.com/en/"), (None, "http://hot.com/"), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = pages.where("page_id is not null").select("page_id", (F.col("page_id") % 2).cast("int").alias("good"))
    found = urls.judge(pages, labels, urls.RULES)
    assert found.count() == len(rows) and found.where("reputation is null").count() == 0
    r = {x.host: x for x in urls.host_reputation(found.join(labels.dropDuplicates(["page_id"]), "page_id", "left").select("host", "good")).collect()}
    assert all(math.isclose(x.reputation, r[x.host].bound) for x in found.select("host", "reputation").distinct().collect())
    assert [x["count"] for x in found.where("host = 'hot.com'").groupBy("rule").count().orderBy(F.col("rule").desc_nulls_last()).collect()] == [3001, 1]


# --- languages --------------------------------------------------------------------


def brute_bits(train, text, langs):
    """Code length by dictionaries of contexts."""
    pad, out = b" " * langid.ORDER, []
    for lang in langs:
        ctx = {}
        for t in train[lang]:
            s = pad + t
            for i in range(len(pad), len(s)):
                for o in range(langid.ORDER + 1):
                    seen = ctx.setdefault(s[i - o : i], {})
                    seen[s[i]] = seen.get(s[i], 0) + 1
        bits, s = 0.0, pad + text
        for i in range(len(pad), len(s)):
            for o in range(langid.ORDER, -1, -1):
                c = ctx.get(s[i - o : i])
                if c is None:
                    continue
                n, d = sum(c.values()), len(c)
                if s[i] in c:
                    bits += math.log2((n + d) / c[s[i]])
                    break
                bits += math.log2((n + d) / d)
            else:
                bits += 8
        out.append(bits)
    return out


def test_code_lengths_match_trees(spark, monkeypatch):
    rnd = random.Random(5)
    train = {"aa": [bytes(rnd.choice(b"abcd ") for _ in range(80)) for _ in range(3)], "bb": [bytes(rnd.choice(b"xyzd ") for _ in range(80)) for _ in range(3)]}
    rows = [(lang, t.decode()) for lang, ts in train.items() for t in ts]
    model = langid.train(spark.createDataFrame([*rows, (None, "zz"), ("cc", None)], "lang string, text string"))
    texts = [b"abcd dcba", b"xyz", b"qqq unseen \xc3\xa9", b"d", b"abcd xyz " * 40]
    want = [brute_bits(train, t, model.langs) for t in texts]
    assert model.langs == ["aa", "bb"] and np.allclose(model.lengths(texts), want, rtol=1e-5)
    monkeypatch.setattr(langid, "CHUNK", 10)  # texts by parts
    assert np.allclose(model.lengths(texts), want, rtol=1e-5)
    mine = {(r.length, r.gram): r.n for r in langid.count_grams(spark.createDataFrame(rows[:3], "lang string, text string")).collect()}
    for k in range(langid.ORDER + 1):
        seen = [int.from_bytes((b" " * langid.ORDER + t)[i - k : i + 1], "big") for t in train["aa"] for i in range(langid.ORDER, len(t) + langid.ORDER)]
        assert {g: n for (o, g), n in mine.items() if o == k} == {g: seen.count(g) for g in seen}


def test_rare_scripts_beside_a_hot_one(spark):
    """More bytes than 127 occur, and those of the rare languages are the rarest."""
    rnd = random.Random(2)
    latin = "".join(map(chr, [*range(33, 127), *range(0xC0, 0x180)]))
    text = lambda a, n: " ".join("".join(rnd.choice(a) for _ in range(5)) for _ in range(n)).encode()
    train = {"hot": [text(latin, 3000)], "one": [text("\u0e01\u0e02\u0e03", 30)], "two": [text("\u0e04\u0e05\u0e06", 30)]}
    model = langid.train(spark.createDataFrame([(lang, t.decode()) for lang, ts in train.items() for t in ts], "lang string, text string"))
    texts = [text("\u0e01\u0e02\u0e03", 3), text("\u0e04\u0e05\u0e06", 3), text(latin, 3), b"\xf4\x8f\xbf\xbf a"]
    assert np.allclose(model.lengths(texts), [brute_bits(train, t, model.langs) for t in texts], rtol=1e-5)
    assert model.predict([t.decode() for t in texts[:3]])[0] == ["one", "two", "hot"]


def test_only_frequent_grams_are_kept_where_there_are_too_many(spark):
    rows = [("a", 1, g, 1 + g // 10) for g in range(1000)] + [("b", 1, g, 5) for g in range(300)] + [("b", 0, g, 7) for g in range(9)]
    counts = spark.createDataFrame(rows, "lang string, length int, gram long, n long")
    assert langid.frequent(counts).count() == len(rows)
    kept = {(r.lang, r.length, r.gram) for r in langid.frequent(counts, grams=305).collect()}
    assert kept == {("a", 1, g) for g in range(700, 1000)} | {("b", 1, g) for g in range(300)} | {("b", 0, g) for g in range(9)}
    assert {r.lang for r in langid.frequent(counts, grams=10).where("length = 1").collect()} == {"a"}  # 300 alike: all or none


def test_scores_tell_text_from_noise(spark):
    """Scores don't grow with length alone: what no language describes scores low however long it is."""
    model = langid.train(spark.read.parquet(f"{TINY}/documents.parquet"))
    rnd = random.Random(8)
    noise = ["".join(rnd.choice("0123456789abcdef") for _ in range(n)) for n in (20, 200, 20_000)] + ["".join(map(chr, (rnd.randrange(0x4E00, 0x9000) for _ in range(500))))]
    assert max(model.predict(noise)[1]) < 0.5
    lang, score = model.predict(["Of the thing and that her.", "Der und die nicht. " * 2000])
    assert lang == ["en", "de"] and min(score) > 0.9


def test_undetermined_and_empty(spark):
    learned = langid.train(spark.createDataFrame([("en", "the and of"), ("de", "der und von")], "lang string, text string"))
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "the of"), (5, "der und " * 50_000)], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, learned).collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0) and found[4][0] == "en" and found[5][0] == "de" and found[5][1] > 0.9
    nothing = langid.train(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}
    with pytest.raises(ValueError):
        langid.identify(df.withColumn("score", F.lit(1)), learned)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    found = langid.op7_ppm_language(spark, TINY).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 30 and sum(r.lang == r.lang_pred for r in found) / len(found) > 0.95


# --- neighbours ---------------------------------------------------------------------


def vectors(spark, n=1500, d=16, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(12, d))[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, d))
    x[200:260] = x[0]  # copies: ties
    rows = [(i, [float(v) for v in x[i]], 7) for i in range(n)]
    odd = [(n, None, 1), (n + 1, [0.0] * d, 1), (n + 2, [float("nan")] * d, 1), (n + 3, [None] + [1.0] * (d - 1), 1), (n + 4, [float("inf")] * d, 1), (n + 5, [1.0, 2.0], 1), (None, [1.0] * d, 1)]
    return x, spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score int")


def test_recall_ties_and_scores(spark):
    x, df = vectors(spark)
    use = ann.usable(df)
    assert use.count() == 1500
    books = ann.train(use, books=8, words=64)
    found = ann.search(ann.build_index(use, books), use, use.where("vec_id % 20 = 0"), books, k=20, rerank=60).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q in range(0, 1500, 20):
        got = sorted(by[q])
        assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
        assert all(s == (x[q] * x[v]).sum() for _, v, s in got)
        assert [(-s, v) for _, v, s in got] == sorted((-s, v) for _, v, s in got)
        exact = (x * x[q]).sum(1)
        exact[q] = -np.inf
        hits += len({g[1] for g in got} & set(np.lexsort((np.arange(1500), -exact))[:20].tolist()))
    assert hits / (75 * 20) >= 0.9


@pytest.mark.parametrize("metric", ann.METRICS)
def test_nearest_are_whole_where_codes_fit_badly(spark, metric):
    """Far from the origin, dense groups larger than the shortlist, lengths of all sizes: every query has exactly its nearest."""
    rng = np.random.default_rng(11)
    near = 3000 + rng.normal(size=(250, 12))
    dense = rng.normal(size=(2, 12))[rng.integers(0, 2, 300)] + 1e-4 * rng.normal(size=(300, 12))
    long = rng.normal(size=(250, 12)) * np.exp(rng.normal(size=(250, 1)) * 2)
    for x in (near, np.concatenate([dense, long])):
        use = ann.usable(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"))
        books = ann.train(use, books=3, words=8)
        found = ann.search(ann.build_index(use, books), use, use.where("vec_id % 20 = 0"), books, k=20, rerank=30, metric=metric).collect()
        got = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in range(0, len(x), 20)}
        for q, ids in got.items():
            exact = (x * x[q]).sum(1) if metric == "ip" else -((x - x[q]) ** 2).sum(1)
            exact[q] = -np.inf
            assert ids == np.lexsort((np.arange(len(x)), -exact))[:20].tolist()


@pytest.mark.parametrize("metric", ann.METRICS)
def test_rows_met_by_blocks_are_brute_force(metric):
    """Blocks in any order, rows whose squares overflow, copies and whole numbers (ties), lengths that lose all digits in single precision, codes of no use."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(900, 12))
    far = x * np.where(rng.random((900, 1)) < 0.05, 1e9, 1)
    books = ann.fit(x, books=4, words=16)
    huge = np.where(np.arange(900)[:, None] % 50 == 0, np.abs(x) * 1e200, x)  # squares overflow
    cases = [(x, books), (huge, books), (huge, ann.fit(huge, books=3, words=8)), (x[rng.integers(0, 5, 900)], books), (np.round(x), books), (x * 1e-200, books), (x * 1e120, books), (1e8 + x, ann.fit(1e8 + x, books=4, words=16)), (far, books), (x, rng.normal(size=(3, 8, 12)) * 100), (x[:12], books)]
    for x, books in cases:
        ids, codes = rng.permutation(len(x)), ann.encode(x, books)
        error = np.sqrt(((x - ann.decode(codes, books)) ** 2).sum(1))
        queries = np.arange(0, len(x), 9)
        near = ann.Nearest(ids[queries], x[queries], books, 20, 30, metric)
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 200)):
            near.meet(ids[at], codes[at], error[at], x[at])
        got = near.batch().to_pydict()
        want = []
        for q in queries:
            score = ann.scores(x, x[q][None], metric)
            best = [r for r in np.lexsort((ids, -score)) if r != q][:20]
            want += [(ids[q], ids[r], score[r]) for r in best]
        assert list(zip(got["query_id"], got["vec_id"], got["score"])) == want


@pytest.mark.parametrize("lanes, wide", [(1, 64_000_000), (3, 1), (3, 1_000)])
def test_search_of_many_tasks_is_brute_force(spark, monkeypatch, lanes, wide):
    x, df = vectors(spark, 400)
    for name, value in {"ROW_BLOCK": 16, "QUERY_BLOCK": 7, "SEARCH_LANES": lanes, "QUERY_BYTES": wide}.items():
        monkeypatch.setattr(ann, name, value)
    use = ann.usable(df)
    books = ann.train(use, books=4, words=16)
    found = ann.search(ann.build_index(use, books), use, use.where("vec_id % 20 = 0"), books, rerank=30).collect()
    want = []
    for q in range(0, 400, 20):
        score = (x * x[q]).sum(1)
        want += [(q, i + 1, v, score[v]) for i, v in enumerate([v for v in np.lexsort((np.arange(400), -score)) if v != q][:20])]
    assert sorted(map(tuple, found)) == want


def test_floats_are_searched_as_doubles(spark):
    x, df = vectors(spark, 200)
    narrow = df.withColumn("embedding", F.col("embedding").cast("array<float>"))
    use = ann.usable(narrow)
    assert use.schema["embedding"].dataType.simpleString() == "array<float>"
    books = ann.train(use, books=4, words=16)
    found = ann.search(ann.build_index(use, books), use, use.where("vec_id = 20"), books).collect()
    x = x.astype(np.float32).astype(np.float64)
    score = (x * x[20]).sum(1)
    best = [v for v in np.lexsort((np.arange(200), -score)) if v != 20][:20]
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [(v, score[v]) for v in best]


def test_search_time_for_each_pair(spark, tmp_path):
    """576 million pairs: tables of inner products took over a minute."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(24_000, 64)).astype(np.float32)
    pq.write_table(pa.table({"vec_id": np.arange(24_000), "embedding": list(x)}), tmp_path / "embeddings.parquet")
    use = ann.usable(spark.read.parquet(str(tmp_path)).repartition(4)).localCheckpoint()
    books = ann.train(use, sample=2048, books=32, words=32)
    index = ann.build_index(use, books).localCheckpoint()
    began = time.monotonic()
    found = ann.search(index, use, use, books).where("query_id < 20").collect()
    assert time.monotonic() - began < 40
    x = x.astype(np.float64)
    for q in range(20):
        score = (x * x[q]).sum(1)
        score[q] = -np.inf
        assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] == np.argsort(-score)[:20].tolist()


def test_few_vectors_and_none(spark):
    _, df = vectors(spark, 30)
    use = ann.usable(df.where("vec_id < 5"))
    books = ann.train(use, books=2, words=8)
    for metric in ann.METRICS:
        found = ann.search(ann.build_index(use, books), use, use.where("vec_id = 0"), books, metric=metric).collect()
        assert sorted(r.vec_id for r in found) == [1, 2, 3, 4]
    assert ann.train(ann.usable(df.limit(0))) is None
    with pytest.raises(ValueError):
        ann.search(use, use, use, books, metric="cosine")


def test_scan_of_many_blocks_is_that_of_one(spark, monkeypatch):
    x, df = vectors(spark, 400)
    use = ann.usable(df)
    books = ann.train(use, books=4, words=16)
    index = ann.build_index(use, books)
    want = sorted(map(tuple, ann.shortlist(index, use.where("vec_id % 20 = 0"), books, 30, "ip").collect()))
    assert len(want) == 20 * 30
    monkeypatch.setattr(ann, "ROW_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    assert sorted(map(tuple, ann.shortlist(index, use.where("vec_id % 20 = 0"), books, 30, "ip").collect())) == want


def test_repeated_ids_are_one_row(spark):
    df = spark.createDataFrame([(1, [2.0, 0.0]), (1, [1.0, 5.0]), (1, [1.0, 5.0]), (2, [3.0, 1.0]), (3, [0.5, 1.0])], "vec_id long, embedding array<double>")
    use = ann.usable(df)
    assert sorted((r.vec_id, r.embedding) for r in use.collect()) == [(1, [1.0, 5.0]), (2, [3.0, 1.0]), (3, [0.5, 1.0])]
    books = ann.train(use, books=2, words=4)
    found = ann.search(ann.build_index(use, books), use, use.where("vec_id = 2"), books).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [(1, 1, 8.0), (2, 3, 2.5)]


def test_beam_search_is_no_worse_than_greedy():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8))
    books = ann.fit(x, books=4, words=16)
    loss = [((x - ann.decode(ann.encode(x, books, b), books)) ** 2).sum() for b in (1, 8)]
    assert loss[1] <= loss[0]


# --- licenses -------------------------------------------------------------------------


def brute_scan(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    places = [(i, label) for p, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    best, labels = 0.0, {label for _, label in places}
    for k in range(0, len(w), licenses.WINDOW // 2):
        own = set(w[k : k + licenses.WINDOW])
        for label, t in licenses.TEMPLATES:
            c = len(own & set(t.split())) / len(set(t.split()))
            if c >= licenses.THRESHOLD - 1e-12:
                labels.add(label)
                best = max(best, c)
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), sorted({label for _, label in places}), sorted(labels), 1.0 if at else best


def test_scan_matches_brute_force(spark):
    rnd = random.Random(8)
    pool = [t for _, t in licenses.TEMPLATES] + [p for p, _ in licenses.PHRASES] + ["cc by nc cc by nc", "CC-BY-NC", "Under the MIT License.", "the mit", "é und ß", "x" * 300]
    texts = [None, "", "...", *pool, *(" ".join(rnd.choice(["\n", " ", ", "]).join(rnd.sample(rnd.choice(pool).split(), 1) * rnd.randint(0, 3) + rnd.choice(pool).split()[: rnd.randint(0, 20)]) for _ in range(rnd.randint(1, 9))) for _ in range(150)), "word " * 5000 + pool[1]]
    df = spark.createDataFrame([(i % 100, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = sorted((tuple(r)[2:] for r in licenses.scan(df).collect()), key=str)
    assert found == sorted((brute_scan(t) for t in texts), key=str)


def test_scan_edges(spark):
    df = spark.createDataFrame([(1, "same"), (1, "same"), (None, "cc by nc")], "doc_id long, text string")
    assert licenses.scan(df).count() == 3 and licenses.scan(df.limit(0)).count() == 0
    overlap = licenses.scan(spark.createDataFrame([("a b a b a",)], "text string"), phrases=[("a b a", "x")]).first()
    assert (overlap.n_base, overlap.first_word, overlap.last_word) == (2, 0, 2)
    with pytest.raises(ValueError):
        licenses.scan(df.withColumn("labels", F.lit(1)))
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_templates_are_found_in_windows_of_their_own(spark):
    """A whole license text has more distinct words than a block of ``WINDOW``."""
    full = next(t for label, t, _ in licenses.NOTICES if label == "mit")
    apache = next(t for label, t, _ in licenses.NOTICES if label == "apache-2")
    own = sorted(set(re.findall("[a-z0-9]+", full.lower())))
    assert len(own) * licenses.THRESHOLD > licenses.WINDOW
    texts = [full, "pad " * 97 + full + " pad" * 50, apache, apache.replace("Apache", "Other").replace("apache", "other"), "nothing"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in licenses.similar_blocks(df, ["doc_id"], licenses.NOTICES).collect():
        found.setdefault(r.doc_id, set()).add((r.label, r.containment))
    assert ("mit", 1.0) in found[0] and ("mit", 1.0) in found[1] and ("apache-2", 1.0) in found[2]
    assert 3 not in found and 4 not in found  # all words but the license's name
    with pytest.raises(ValueError):
        licenses.similar_blocks(df, ["doc_id"], licenses.NOTICES, window=licenses.WINDOW)
    assert {licenses.window_of(t) for t in licenses.TEMPLATES} == {licenses.WINDOW}


# --- transcripts ------------------------------------------------------------------------


def test_chunks_of_any_size_find_the_best_path(spark):
    lines = transcripts.raw_lines(spark.read.parquet(f"{TINY}/conversations.parquet").where("conv_id < 6"))
    hmm = transcripts.fit(lines)
    with pytest.raises(ValueError):
        transcripts.parse(lines, hmm, 1)
    want = sorted(map(str, transcripts.parse(lines.select("conv_id", "place", "line"), hmm).collect()))
    for size in (2, 5):
        assert sorted(map(str, transcripts.parse(lines.select("conv_id", "place", "line"), hmm, size).collect())) == want


def test_path_is_best_of_all():
    rng = np.random.default_rng(2)
    hmm = transcripts.Hmm(rng.integers(0, 9, (transcripts.STATES + 1, transcripts.STATES)), rng.integers(0, 9, (transcripts.STATES, transcripts.OBSERVATIONS)))
    m = hmm.matrices(rng.integers(0, transcripts.OBSERVATIONS, 5))
    end = int(transcripts.product(m)[transcripts.STATES].argmax())
    path = [*transcripts.states_between(m, transcripts.STATES, end), end]
    score = lambda p: sum(m[k][a, b] for k, (a, b) in enumerate(zip((transcripts.STATES, *p), p)))
    assert score(path) == pytest.approx(max(score(p) for p in itertools.product(range(transcripts.STATES), repeat=5)))


def test_rendering_keeps_everything_but_markers(spark):
    """Each turn is closed, and a transcript's texts are its lines less the markers that opened turns."""
    hmm = transcripts.fit(transcripts.raw_lines(spark.read.parquet(f"{TINY}/conversations.parquet")))
    place = lambda k: (k, 0, 0)
    texts = ["System: be good", "User: what", "https://example.org/page", "Note: keep this word", "Result: 5", "is it <|end|>?", "Assistant: this", "", "User: and?", "[A]: done"]
    rows = [(1, place(k), t) for k, t in enumerate(texts)] + [(None, place(0), None), (2, place(0), "User: "), (2, place(0), "User: "), (3, place(0), "long " * 20_000)]
    lines = spark.createDataFrame(rows, "conv_id long, place struct<turn:long,text:long,row:int>, line string")
    for chunk in (2, 512):
        found = transcripts.parse(lines, hmm, chunk)
        assert found.count() == len(rows)
        out = {(r.conv_id, r.turn_no): r for r in transcripts.turns(found).collect()}
        mine = [out[1, k] for k in range(1, 1 + sum(c == 1 for c, _ in out))]
        starts = {(r.role, r.text.split("\n")[0]) for r in mine}
        assert {("system", "be good"), ("user", "what"), ("assistant", "this"), ("user", "and?"), ("assistant", "done")} <= starts
        assert "\n".join(r.text for r in mine) == "\n".join(re.sub(r"^(System|User|Assistant|\[A\]): ", "", t) for t in texts)
        whole = "".join(r.rendered for r in mine)
        assert whole.count("<|end|>") == len(mine) and whole.endswith("<|assistant|>\ndone<|end|>\n") and "is it <||end|>?" in whole
        assert out[None, 1].text == "" and out[3, 1].text == "long " * 20_000 and sum(r.n_lines for (c, _), r in out.items() if c == 2) == 2
    none = lines.limit(0)
    assert transcripts.turns(transcripts.parse(none, transcripts.fit(none.selectExpr("*", "'user' as role", "true as is_first")))).count() == 0


def test_fit_counts_every_line_and_its_neighbour(spark):
    """By range partitions as by loops, whatever their number, on one long transcript and on short ones."""
    rnd = random.Random(3)
    rows = [(c, (k, 0, 0), rnd.choice(["User: a", "b?", "Assistant: " + "c" * 300, "d"]), rnd.choice(["user", "assistant", "other"]), rnd.random() < 0.5) for c, n in ((1, 400), (None, 90), (2, 1), (3, 40)) for k in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, place struct<turn:long,text:long,row:int>, line string, role string, is_first boolean")
    move = np.zeros((transcripts.STATES + 1, transcripts.STATES))
    last = {}
    for c, _, _, role, first in rows:
        if role != "other":
            state = 2 * transcripts.ROLES.index(role) + (not first)
            move[last.get(c, transcripts.STATES), state] += 1
            last[c] = state
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = transcripts.fit(df)
        assert np.allclose(found.move[:, : transcripts.STATES], np.log((move + 1) / (move + 1).sum(1, keepdims=True)))
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_held_out_roles(spark):
    """Lines of marked and unmarked turns; the latter alone are much harder."""
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    lines = transcripts.raw_lines(conversations)
    hmm = transcripts.fit(lines.where(~transcripts.held_out(F.col("conv_id"))))
    given = lines.where(transcripts.held_out(F.col("conv_id")))
    found = transcripts.parse(given, hmm).withColumnRenamed("role", "found").join(given.select("conv_id", "place", "role"), ["conv_id", "place"]).collect()
    right = [r.role == r.found for r in found]
    assert len(found) > 100 and sum(right) / len(found) > 0.93
    out = transcripts.op10_transcript_roles(spark, "/root/testdata/sf0.01")
    assert out.agg(F.sum("n_lines")).first()[0] == lines.count() and out.columns[:5] == ["conv_id", "turn_no", "held_out", "role_pred", "n_lines"]
