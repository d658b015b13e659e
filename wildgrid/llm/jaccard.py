"""N-gram Jaccard join by universe partition and pigeonhole, verified exactly.

A text's set holds its distinct shingles of ``words`` words, as 64-bit hashes. Texts
with equal sets (size and 128-bit digest) are one node. Two sets R, S (|R| >= |S|) of
similarity t or more differ in at most H = (1 - t) / (1 + t) * (|R| + |S|) elements.

* Bands: sizes are cut into bands; a band's ``segments`` exceed every H in it. A
  hash deals the universe of shingles to the band's segments.
* Index: each set has one signature for each segment of its own band (the sum of the
  mixed hashes in it), and for the first ``NEIGHBOURS`` segments also those of the
  segment less one element (its one-deletion neighbourhood).
* Probe: a set looks in its own band and in the bands below that still hold sizes
  within t. If equal segments count 1, and equality up to one element counts 2, a
  similar pair can't fail at segments worth H + 1 in all. So R may leave out
  segments worth what it has beyond H + 1.
* Cost: the allocation leaves out the segments with the most rows, as counted over
  the whole index.

First every member is compared with its bucket's pivot (the member that shares the
most); links give components. Then only buckets that still span several components
are left, less the segments that the allocation leaves out; their members are compared
across components, after a bound on the difference by parities. Links inside a
component add nothing to components, so none between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, forget, table, written

#: Segments whose one-deletion neighbourhoods are indexed.
NEIGHBOURS = 2
#: A band's largest size to its smallest.
RATIO = 1.25
#: 64-bit parities kept for each set; the population count of their difference bounds that of the sets from below.
PARITIES = 8
#: Words that one worker keeps with their hashes, and the longest such word in bytes: both bound its memory.
WORD_MEMO, LONG = 400_000, 64
#: Rows of an Arrow batch: texts, and pairs of whole sets, may be wide, and a task holds a batch on both sides.
BATCH = 256
INDEX, PROBE, LESS = 1, 2, 4

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Word to hash; a new word is hashed when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMO:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG:
            self[word] = h
        return h


_words = _Words()


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of a text: sorted hashes. Fewer words than ``words``: the whole sequence as one element."""
    split = (text or "").encode().translate(_LOWER).split()
    if not split:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, split), np.uint64, len(split))
    k = min(words, len(w))
    n = len(w) - k + 1
    with np.errstate(over="ignore"):
        h = np.full(n, k, np.uint64)
        for j in range(k):
            h = _mix(h * _M2 + w[j : j + n])
    return np.unique(h)


class Bands:
    """Sizes, segments and what a probe needs, for a threshold of ``percent``."""

    def __init__(self, percent: int, ratio: float = RATIO):
        self.percent = percent
        low = [1]
        while low[-1] < 1 << 40:
            low.append(max(low[-1] + 1, int(low[-1] * ratio)))
        self.low = np.array(low)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.low, size, "right")) - 1

    def high(self, band: int) -> int:
        return int(self.low[band + 1]) - 1

    def apart(self, r: int, s: int) -> int:
        """Elements in which similar sets of sizes up to r and s differ at most."""
        return (100 - self.percent) * (r + s) // (100 + self.percent)

    def segments(self, band: int) -> int:
        s = self.high(band)
        return self.apart(s * 100 // self.percent, s) + 1

    def probes(self, size: int) -> list[tuple[int, int]]:
        """(band, segments less those that a set of this size needs there), its own band first."""
        out, band = [], self.of(size)
        while band >= 0 and self.high(band) * 100 >= self.percent * size:
            m = self.segments(band)
            if m > 1:  # with one segment, similar sets are equal, and those are one node
                need = self.apart(size, min(size, self.high(band))) + 1
                out.append((band, m - need))
            band -= 1
        return out


def signatures(s: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, meta) of a set; meta packs kind (3 bits), what may be left out (20), band (8), segment (24)."""
    sigs, metas, own = [], [], bands.of(len(s))
    mixed = _mix(s)
    for band, spare in bands.probes(len(s)):
        m = bands.segments(band)
        seg = (mixed % np.uint64(m)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed[order], dtype=np.uint64)])
        ends = np.searchsorted(seg[order], np.arange(m + 1))
        sums, size = upto[ends[1:]] - upto[ends[:-1]], np.diff(ends)
        salt = _mix(np.arange(m).astype(np.uint64) + np.uint64(band << 32))
        # equality up to one element counts 2 where less than all can be missing
        wide = np.flatnonzero(size[:NEIGHBOURS] > 1)
        spare += len(wide)
        probed = np.ones(m, bool)
        empty = np.flatnonzero(size == 0)[: max(0, spare)]  # left out first: everybody has some
        probed[empty] = False
        kind = np.where(probed, PROBE, 0) | (INDEX if band == own else 0)
        meta = min((1 << 20) - 1, spare - len(empty)) << 3 | band << 23 | np.arange(m) << 31 | kind
        kept = kind > 0
        sigs.append(_mix(sums ^ salt)[kept])
        metas.append(meta[kept])
        for k in wide:
            less = sums[k] - mixed[order[ends[k] : ends[k + 1]]]
            sigs.append(_mix(less ^ salt[k]))
            metas.append(np.full(len(less), meta[k] | LESS))
    if not sigs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(sigs).view(np.int64), np.concatenate(metas)


def parities(s: np.ndarray) -> np.ndarray:
    bit = (_mix(s ^ _M3) % np.uint64(64 * PARITIES)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def scaled_parities(s: np.ndarray) -> np.ndarray:
    """Parities of at least as many bits as the set has elements, a power of two; half of them folded on the other are those of half the length."""
    bits = 1 << max(9, (len(s) - 1).bit_length())
    odd = np.bincount((_mix(s ^ _M2) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def difference_bound(x: np.ndarray, y: np.ndarray) -> int:
    """Two sets differ in so many elements at least, by their scaled parities."""
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


# --- passes over texts ----------------------------------------------------------


def _set_keys(docs: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                s = shingles(text, words)
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                out.append((len(s), (d & (1 << 63) - 1), d >> 65))
            n, x, y = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int32()), pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["doc_id", "n", "x", "y"])

    return docs.mapInArrow(run, "doc_id long, n int, x long, y long")


def _signature_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                sigs, metas, reps, sizes = [], [], [], []
                for rep, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    s = shingles(text, words)
                    if len(s):
                        sig, meta = signatures(s, bands)
                        sigs.append(sig)
                        metas.append(meta)
                        reps.append(np.full(len(sig), rep))
                        sizes.append(np.full(len(sig), len(s), np.int32))
                if sigs:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (sigs, reps, metas, sizes)], names=["sig", "rep", "meta", "size"])

    return docs.mapInArrow(run, "sig long, rep long, meta long, size int")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    names = [f"p{i}" for i in range(PARITIES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                sets = [shingles(t, words) for t in part.column("text").to_pylist()]
                odd = np.array([parities(s) for s in sets]).reshape(-1, PARITIES)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([scaled_parities(s).tobytes() for s in sets], pa.binary()), *[pa.array(odd[:, i]) for i in range(PARITIES)]], names=["rep", "size", "elements", "odd", *names])

    return docs.mapInArrow(run, "rep long, size int, elements binary, odd binary, " + ", ".join(f"{n} long" for n in names))


# --- pairs ----------------------------------------------------------------------


def _near(percent: int, a: str, b: str) -> Column:
    """Sizes within the threshold, and parities that differ in no more than similar sets can."""
    size_a, size_b = F.col(f"{a}.size").cast("long"), F.col(f"{b}.size").cast("long")
    differ = sum((F.bit_count(F.col(f"{a}.p{i}").bitwiseXOR(F.col(f"{b}.p{i}"))) for i in range(1, PARITIES)), F.bit_count(F.col(f"{a}.p0").bitwiseXOR(F.col(f"{b}.p0"))))
    return (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)) & (differ * (100 + percent) <= (100 - percent) * (size_a + size_b))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold, by the exact sizes of intersection and union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ea"), batch.column("eb")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"])

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, m, n in zip(batch.column("oa"), batch.column("ob"), batch.column("na").to_pylist(), batch.column("nb").to_pylist()):
                apart = difference_bound(*(np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y)))
                keep.append(100 * min(m, n) >= percent * max(m, n) and apart * (100 + percent) <= (100 - percent) * (m + n))
            part = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"])

    def beside(df: DataFrame, **columns: str) -> DataFrame:
        for end in "ab":
            df = df.join(sets.select(F.col("rep").alias(end), *[F.col(c).alias(n + end) for n, c in columns.items()]), end)
        return df

    near = written(beside(pairs, o="odd", n="size").select("a", "b", "oa", "ob", "na", "nb").mapInArrow(prune, "a long, b long"), "near", BATCH)
    full = beside(near, e="elements")
    return full.select("a", "b", "ea", "eb").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> node, component (the smallest node reachable): large stars and small stars in turn, until nothing changes."""
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        old, e = e, written(small, "edges")
        forget(old)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select("v", F.col("v").alias("component")).distinct().toDF("node", "component"))


def _bits(column: str, shift: int, width: int) -> Column:
    return F.shiftright(F.col(column), shift).bitwiseAND(F.lit((1 << width) - 1))


def _texts_of_one_id(keys: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): the nodes of a doc_id with several texts, each with the smallest of them. Ids and digests alone are shuffled."""
    mine = keys.where("n > 0 and doc_id is not null")
    several = written(mine.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "repeated-ids")
    of_id = mine.join(several, "doc_id").join(nodes, ["n", "x", "y"]).select("doc_id", "rep").distinct()
    least = of_id.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return of_id.join(least, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def near_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id: one row for each row.

    component_id is the smallest doc_id reachable by links, itself included. Texts
    without words (null, empty) have no shingles and are linked with nothing. Rows
    that share a doc_id are one document of several texts, so a link of one of these
    is a link of the document, and all texts of an id have the same component. A null
    doc_id has a null component and takes no part. Other columns are ignored; an empty
    table gives none.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = written(_set_keys(docs, words), "sets", BATCH)
    nodes = keys.where("n > 0 and doc_id is not null").groupBy("n", "x", "y").agg(F.min("doc_id").alias("rep"))
    nodes = written(nodes, "nodes")
    same_id = _texts_of_one_id(keys, nodes)

    texts = docs.join(nodes.select("rep").distinct().hint("shuffle_hash"), F.col("doc_id") == F.col("rep"), "left_semi")
    rows = _signature_rows(texts, words, percent)
    bucket, kind = Window.partitionBy("sig"), _bits("meta", 0, 3)
    asked = F.max(kind.bitwiseAND(F.lit(PROBE))).over(bucket) > 0
    shared = rows.withColumn("n", F.count("*").over(bucket)).withColumn("asked", asked).where("n > 1 and asked").drop("asked")
    shared = written(shared, "shared", BATCH)
    sets = _sets(docs.join(shared.select("rep").distinct().hint("shuffle_hash"), F.col("doc_id") == F.col("rep"), "left_semi"), words)
    sets = written(sets, "elements", BATCH)

    share = shared.where(kind.bitwiseAND(F.lit(LESS)) == 0).groupBy("rep").agg(F.sum("n").alias("share"))
    pivots = shared.where(kind.bitwiseAND(F.lit(INDEX)) > 0).join(share, "rep", "left").groupBy("sig").agg((-F.max(F.struct("share", -F.col("rep")))["col2"]).alias("pivot"))
    first = shared.join(pivots, "sig").where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    links = written(_linked(first, sets, percent).unionByName(same_id), "links", BATCH)
    found = written(components(links), "components")

    label = shared.where("n > 2").join(found, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep")).drop("node")
    mixed = label.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("sig")
    rest = written(label.join(mixed, "sig"), "rest")
    forget(shared, links)
    band, segment, spare = _bits("meta", 23, 8), _bits("meta", 31, 24), _bits("meta", 3, 20)
    probe = rest.where(kind.bitwiseAND(F.lit(PROBE)) > 0).withColumns({"band": band, "segment": segment, "spare": spare})
    costs = probe.groupBy("rep", "size", "band", "segment", "spare").agg(F.sum("n").alias("cost"))
    worth = F.when(F.col("segment") < NEIGHBOURS, 2).otherwise(1)
    order = Window.partitionBy("rep", "size", "band").orderBy(F.col("cost").desc(), "segment").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left_out = costs.withColumn("worth", F.sum(worth).over(order)).where(F.col("worth") <= F.col("spare")).select("rep", "size", "band", "segment")
    light = sets.select("rep", "size", *[f"p{i}" for i in range(PARITIES)])
    probe = probe.join(left_out, ["rep", "size", "band", "segment"], "left_anti").join(light, ["rep", "size"])
    index = rest.where(kind.bitwiseAND(F.lit(INDEX)) > 0).join(light, ["rep", "size"])
    larger = (F.col("r.size") > F.col("s.size")) | ((F.col("r.size") == F.col("s.size")) & (F.col("r.rep") > F.col("s.rep")))
    one_whole = F.col("r.meta").bitwiseAND(F.col("s.meta")).bitwiseAND(F.lit(LESS)) == 0
    across = probe.alias("r").join(index.alias("s"), (F.col("r.sig") == F.col("s.sig")) & (F.col("r.component") != F.col("s.component")) & larger & one_whole & _near(percent, "r", "s"))
    second = across.select(F.least("r.rep", "s.rep").alias("a"), F.greatest("r.rep", "s.rep").alias("b")).distinct()
    more = written(_linked(second, sets, percent), "more-links", BATCH)
    named = more.join(found.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(found.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
    joined = written(components(named.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))), "joined")
    forget(sets, rest)

    of_node = nodes.join(found, F.col("rep") == F.col("node"), "left").select("n", "x", "y", F.coalesce("component", "rep").alias("c"))
    of_node = of_node.join(joined, F.col("c") == F.col("node"), "left").select("n", "x", "y", F.coalesce("component", "c").alias("c"))
    out = keys.join(of_node, ["n", "x", "y"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"), words=3, percent=90)


OP4_SQL = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
), s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) end) as g from w
), n as (select doc_id, count(*) as n from s group by doc_id
), p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)
), d as (select a, b from e union all select b, a from e
), r(a, b) as (select doc_id, doc_id from documents union select r.a, d.b from r join d on r.b = d.a)
select documents.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c as component_id
from documents left join n using (doc_id) join (select a, min(b) as c from r group by a) q on q.a = documents.doc_id
"""
