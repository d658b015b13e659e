"""What an ordered chain of filters removes, and what each filter would remove alone.

A table-driven transducer reads the UTF-8 bytes of each text once. Every byte belongs to
a class; the class decides the next state (between words or inside one), and the pair of state and
class decides what is emitted: the start or the end of a word, a capital, a code point, a
symbol. As each class leads to one state whatever the state before it, the states of all
bytes of a window are one gather, and so is what they emit. Word spans go into a hash
table of the document (``SpanTable``), where equal hashes are verified byte by byte, so
distinct words are exact.

The failures of a document are one number (a bit a filter). All counts of all orders follow
from how many documents of a part fail the same set of filters, 32 sums a part, so
the 120 orders cost nothing that grows with the documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, table

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, SYMBOLS = 50, 65, 5, "#$%&*|"
#: Bytes that are read at a time; a longer text is cut between words. Bounds a worker's memory.
WINDOW = 1 << 21
#: Words of more bytes are hashed and compared as slices, shorter ones eight bytes of all words at a time.
LONG = 64

# --- the transducer -----------------------------------------------------------

OTHER, SPACE, CAPITAL, SYMBOL, INNER = range(5)
BETWEEN, INSIDE = range(2)
#: Classes of bytes. INNER: the bytes of a code point after its first.
CLASS = np.full(256, OTHER, np.uint8)
CLASS[list(map(ord, SPACES))] = SPACE
CLASS[ord("A") : ord("Z") + 1] = CAPITAL
CLASS[list(map(ord, SYMBOLS))] = SYMBOL
CLASS[0x80:0xC0] = INNER
#: NEXT[state, class]
NEXT = np.array([[INSIDE, BETWEEN, INSIDE, INSIDE, INSIDE]] * 2, np.uint8)
OPENS, CLOSES, COUNTS_CAPITAL, COUNTS_POINT, COUNTS_SYMBOL = 1, 2, 4, 8, 16
#: EMIT[state, class]
EMIT = np.array([[0, 0, COUNTS_CAPITAL, COUNTS_SYMBOL, 0]] * 2, np.uint8)
EMIT[:, [OTHER, SPACE, CAPITAL, SYMBOL]] |= COUNTS_POINT
EMIT[BETWEEN, [OTHER, CAPITAL, SYMBOL, INNER]] |= OPENS
EMIT[INSIDE, SPACE] |= CLOSES
assert (NEXT[BETWEEN] == NEXT[INSIDE]).all(), "a class must lead to one state"


def emitted(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """What each byte emits. ``begins``: places where a text begins, whose state is BETWEEN."""
    kind = CLASS[data]
    state = np.empty(len(data), np.uint8)
    state[:1], state[1:] = BETWEEN, NEXT[BETWEEN][kind[:-1]]
    state[begins[begins < len(data)]] = BETWEEN
    return EMIT[state, kind]


# --- distinct words -----------------------------------------------------------

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


class SpanTable:
    """Open-addressed hash table of (document, word) whose words are spans of ``data``.

    Inserts are rounds over all words at once: each takes or meets a slot; words that meet
    the same hash, document and length are compared byte by byte, all others go on to the next slot.
    """

    def __init__(self, data: np.ndarray):
        self.data = data
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        #: the eight bytes from each place on
        self.eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
        self.slots = np.full(1 << 12, -1, np.int64)
        self.doc, self.start, self.size, self.hash = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))

    def _hashes(self, doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        h = (doc.astype(np.uint64) + np.uint64(1)) * _MIX ^ size.astype(np.uint64)
        todo = np.flatnonzero(size <= LONG)
        at = 0
        while len(todo):
            part = self.eight[start[todo] + at] & _MASK[np.minimum(size[todo] - at, 8)]
            x = (h[todo] ^ part) * _MIX
            h[todo] = x ^ (x >> np.uint64(29))
            at += 8
            todo = todo[size[todo] > at]
        for k in np.flatnonzero(size > LONG):
            h[k] ^= np.uint64(hash(self.data[start[k] : start[k] + size[k]].tobytes()) & (2**64 - 1))
        return h ^ (h >> np.uint64(32))

    def _same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the spans of ``size`` bytes from ``a`` and from ``b`` on are equal."""
        equal = np.ones(len(a), bool)
        todo = np.flatnonzero(size <= LONG)
        at = 0
        while len(todo):
            mask = _MASK[np.minimum(size[todo] - at, 8)]
            equal[todo] &= (self.eight[a[todo] + at] & mask) == (self.eight[b[todo] + at] & mask)
            at += 8
            todo = todo[equal[todo] & (size[todo] > at)]
        for k in np.flatnonzero(size > LONG):
            equal[k] = np.array_equal(self.data[a[k] : a[k] + size[k]], self.data[b[k] : b[k] + size[k]])
        return equal

    def insert(self, doc: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Adds the words; returns the documents of those that were new, one entry each."""
        if 2 * (len(self.doc) + len(doc)) > len(self.slots):
            self.slots = np.full(1 << int(4 * (len(self.doc) + len(doc))).bit_length(), -1, np.int64)
            self._place(np.arange(len(self.doc)))
        before = len(self.doc)
        h = self._hashes(doc, start, size)
        # words of this call lie behind those known until they are found to be old
        self.doc, self.start, self.size, self.hash = (np.concatenate(x) for x in ((self.doc, doc), (self.start, start), (self.size, size), (self.hash, h)))
        new = self._place(np.arange(before, len(self.doc)))
        keep = np.concatenate([np.ones(before, bool), new])
        moved = np.cumsum(keep) - 1
        used = self.slots >= 0
        self.slots[used] = moved[self.slots[used]]
        self.doc, self.start, self.size, self.hash = self.doc[keep], self.start[keep], self.size[keep], self.hash[keep]
        return self.doc[before:]

    def _place(self, todo: np.ndarray) -> np.ndarray:
        """Finds a slot for each entry; whether it took one (else an equal word has it)."""
        first, took, last = todo[:1].sum(), np.zeros(len(todo), bool), len(self.slots) - 1
        slot = (self.hash[todo] & np.uint64(last)).astype(np.int64)
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]  # of several the last takes it
            owner = self.slots[slot]
            mine = owner == todo
            took[todo[mine] - first] = True
            todo, slot, owner = todo[~mine], slot[~mine], owner[~mine]
            alike = np.flatnonzero((self.hash[owner] == self.hash[todo]) & (self.doc[owner] == self.doc[todo]) & (self.size[owner] == self.size[todo]))
            old = np.zeros(len(todo), bool)
            old[alike] = self._same(self.start[owner[alike]], self.start[todo[alike]], self.size[todo[alike]])
            todo, slot = todo[~old], (slot[~old] + 1) & last
        return took


def measures(data: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """(documents, 5) of words, distinct words, capitals, code points and symbols of the texts that lie one after another in ``data``."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    out = np.zeros((len(ends), 5), np.int64)
    first = 0
    while first < len(ends):
        # whole texts up to a window's bytes, one text at least
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + window, "right")))
        lo, hi = int(starts[first]), int(ends[last - 1])
        spans, at = None, lo
        while at < hi:
            to = min(hi, at + window)
            if to < hi:  # one long text: cut behind white space
                found = np.flatnonzero(CLASS[data[at:to]] == SPACE)
                while not len(found) and to < hi:
                    at_, to = to, min(hi, to + window)
                    found = np.flatnonzero(CLASS[data[at_:to]] == SPACE) + (at_ - at)
                to = to if to == hi and not len(found) else at + int(found[-1]) + 1
            begins = starts[first:last]
            begins = begins[(begins >= at) & (begins < to)] - at
            what = emitted(data[at:to], begins)
            # the text of each byte; empty texts have none
            doc_ends = np.clip(ends[first:last], at, to) - at
            sums = lambda bit: np.diff(np.concatenate([[0], np.cumsum((what & bit) > 0)])[np.concatenate([[0], doc_ends])])  # noqa: B023, E731
            opened = np.flatnonzero(what & OPENS)
            doc = np.searchsorted(doc_ends, opened, "right")
            # a word ends where it closes, where its text ends, or where the next word opens
            edge = np.concatenate([np.flatnonzero(what & CLOSES), doc_ends])
            edge.sort()
            closed = edge[np.searchsorted(edge, opened, "right")] if len(opened) else opened
            for column, bit in ((2, COUNTS_CAPITAL), (3, COUNTS_POINT), (4, COUNTS_SYMBOL)):
                out[first:last, column] += sums(bit)
            out[first:last, 0] += np.bincount(doc, minlength=last - first)
            if spans is None:
                spans = SpanTable(data[lo:hi])
            new = spans.insert(doc + first, opened + (at - lo), closed - opened)
            out[first:last, 1] += np.bincount(new - first, minlength=last - first)
            at = to
        first = last
    return out


# --- failures -----------------------------------------------------------------


def text_failures(m: np.ndarray) -> np.ndarray:
    """Bits of the filters that a text decides alone (A to D), from ``measures``."""
    words, distinct, capitals, points, symbols = m.T
    return (words < MIN_WORDS) | (100 * distinct < MIN_DISTINCT * words) << 1 | (100 * capitals > MAX_CAPITALS * points) << 2 | (symbols > 0) << 3


def named(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (of the text), text as bytes. A null text is an empty one."""
    text, part = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.cast("binary").alias("text"))


def judged(docs: DataFrame) -> DataFrame:
    """Of ``named`` rows: doc_id, part, digest, fails (bits A to D)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            column = b.column("text")
            wide = pa.types.is_large_binary(column.type)
            offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            fails = text_failures(measures(data, offsets[1:] - offsets[0]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), b.column("digest"), pa.array(fails.astype(np.int32))], names=["doc_id", "part", "digest", "fails"])

    return docs.mapInArrow(run, "doc_id long, part string, digest binary, fails int")


def with_copies(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds E's bit to the ``judged`` rows of ``docs``: a row's text is also that of a row with a smaller doc_id, anywhere in the table.

    Rows without doc_id neither are nor have smaller ones; rows that share the smallest id are no copies of each other.
    Texts that occur once meet nothing; a text of a third of all rows is one row of the other side, so Spark can split its rows.
    """
    seen = docs.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("digest", "least")
    found = rows.join(seen, "digest", "left").withColumn("fails", F.col("fails") + F.when(F.col("doc_id") > F.col("least"), 1 << 4).otherwise(0))
    return found.select("doc_id", "part", "fails")


def failure_sets(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """part, sets: for each set of failed filters (its bits are its place) how many documents fail just that set (n), of these good and toxic ones."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    sums = rows.join(marks, "doc_id", "left").groupBy("part", "fails").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return sums.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))  # 32 at most


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included.

    docs: doc_id, text, source; labels: doc_id, quality, toxic; other columns are ignored.
    Part: a source; rows whose source is null or empty are one part. A null text is empty:
    it fails A alone (and E, if it isn't the smallest of the empty ones); repeated rows each count; several labels
    of one document count as good, or as toxic, if one of them says so. An empty table has no parts and gives no rows.
    """
    orders = F.split(F.lit(",".join(map("".join, itertools.permutations(FILTERS)))), ",")
    bits = "aggregate(split({}, ''), 0, (a, c) -> a + if(c = '', 0, shiftleft(1, instr('" + FILTERS + "', c) - 1)))"
    # 600 fixed rows, beside each part
    docs = named(docs)
    found = failure_sets(with_copies(judged(docs), docs), labels).withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    found = found.withColumns({"bit": F.expr(bits.format("substr(filter_order, step, 1)")), "before": F.expr(bits.format("left(filter_order, step - 1)"))})
    own, early = lambda s: s["fails"].bitwiseAND(F.col("bit")) != 0, lambda s: s["fails"].bitwiseAND(F.col("before")) != 0

    def total(which, what: str = "n") -> Column:
        return F.aggregate(F.filter("sets", which), F.lit(0).cast("long"), lambda a, s: a + s[what])

    # of the 120 orders a filter comes first among the k that a document fails in 120 / k
    share = F.aggregate(F.filter("sets", own), F.lit(0).cast("long"), lambda a, s: a + s["n"] * (F.lit(120) / F.bit_count(s["fails"])).cast("long"))
    return found.select(
        "part", "filter_order", "step",
        total(lambda s: ~own(s) & ~early(s)).alias("kept"), total(lambda s: own(s) & ~early(s)).alias("removed"), total(lambda s: own(s) & early(s)).alias("redundant"),
        total(lambda s: s["fails"] == F.col("bit")).alias("unique_fails"), total(lambda s: own(s) & ~early(s), "good").alias("good_lost"),
        total(lambda s: own(s) & ~early(s), "toxic").alias("toxic_lost"), share.alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce("text", '') AS body,
         list_filter(string_split_regex(coalesce("text", ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
firsts AS (SELECT body, min(doc_id) AS least FROM words GROUP BY body),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN words.doc_id > least THEN 'E' ELSE '' END AS f
  FROM words JOIN firsts USING (body) LEFT JOIN marks USING (doc_id)),
sets AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x) JOIN letters d ON d.x NOT IN (a.x, b.x, c.x)
  JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (
  SELECT filter_order, s::INT AS step, substr(filter_order, s, 1) AS own, string_split(left(filter_order, s - 1), '') AS early
  FROM orders, range(1, 6) AS r(s)),
found AS (
  SELECT part, filter_order, step, own, n, good, toxic, contains(f, own) AS mine, f = own AS alone,
         step > 1 AND len(list_filter(early, lambda x: x <> '' AND contains(f, x))) > 0 AS gone
  FROM sets, steps),
counted AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT mine AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mine AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN mine AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN mine AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mine AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM found GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM counted
"""
