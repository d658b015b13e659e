"""Transcript parsing: a hidden Markov model finds the speakers' roles line by line, then turns are rendered.

States are (role, first line of a turn or a later one). A line is observed by the
class of the speaker marker it begins with, whether it ends in a question mark, and
its length. Start, transition and observation frequencies are counted over all
labelled lines, with one added; only those counts reach the driver, and their number
is bounded by states and observations. Viterbi's best path is exact for
transcripts of any length: lines are cut into chunks, each chunk's best scores from
every state to every state are one matrix, matrices are multiplied (max, +) level by
level, and the states at the borders come back down the same way. No task holds
more than a chunk of lines or of matrices.

Rendering. A line that opens a turn loses its marker if that names the role found; every
other character stays. A turn is written as its role's tag, its lines, and an end tag.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # role * 2 + (0: first line, 1: later line)
#: Speaker markers by class, as they stand at the begin of a line, lower-cased.
MARKERS = {
    "system": ("system", "instructions", "context", "prompt"),
    "user": ("user", "human", "question", "q", "customer", "instruction", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "response", "model", "agent"),
}
MARKER = r"^\s*(?:<\|\s*|\[\s*|#{1,6}\s*|\*{1,2}\s*)?([A-Za-z]{1,14})(?:\s+\d{1,2})?\s*(?:\|>|\]|\*{1,2})?\s*:\s*"
CLASSES, LENGTHS = len(MARKERS) + 2, (80, 240, 480)
OBSERVATIONS = CLASSES * 2 * (len(LENGTHS) + 1)
CHUNK = 512


def marker_kind(line: Column) -> Column:
    """0 without a marker, role number + 1 for a known one, ``CLASSES`` - 1 for any other word before a colon."""
    name = F.lower(F.regexp_extract(line, MARKER, 1))
    kind = F.when(name == "", 0)
    for k, role in enumerate(ROLES):
        kind = kind.when(name.isin(*MARKERS[role]), k + 1)
    return kind.otherwise(CLASSES - 1)


def observation(line: Column) -> Column:
    """Number of a line's observation: marker class, question mark, length."""
    asks = F.rtrim(line).endswith("?").cast("int")
    size = sum((F.length(line) >= n).cast("int") for n in LENGTHS)
    return F.coalesce((marker_kind(line) * 2 + asks) * (len(LENGTHS) + 1) + size, F.lit(0)).cast("int")


def content(line: Column, role: Column, is_first: Column) -> Column:
    """A line without its marker, if it opens a turn and the marker names the turn's role; else the line as it is."""
    named = F.element_at(F.array(*map(F.lit, ["", *ROLES, ""])), marker_kind(line) + 1)
    return F.when(is_first & (named == role), F.regexp_replace(line, MARKER, "")).otherwise(line)


class Hmm:
    """Logarithms of transition and observation frequencies. The last state is the one before a transcript."""

    def __init__(self, move: np.ndarray, see: np.ndarray):
        self.move = np.full((STATES + 1, STATES + 1), -np.inf)
        self.see = np.full((STATES + 1, OBSERVATIONS), -np.inf)
        self.move[:, :STATES] = np.log((move + 1) / (move + 1).sum(-1, keepdims=True))
        self.see[:STATES] = np.log((see + 1) / (see + 1).sum(-1, keepdims=True))

    def matrices(self, observed: np.ndarray) -> np.ndarray:
        """For each line: score from the state before to its own."""
        return self.move[None] + self.see[:, observed].T[:, None, :]


def product(matrices: np.ndarray) -> np.ndarray:
    out = matrices[0]
    for m in matrices[1:]:
        out = (out[:, :, None] + m[None]).max(1)
    return out


def states_between(matrices: np.ndarray, begin: int, end: int) -> list[int]:
    """The best states behind each matrix but the last, from ``begin`` before the first to ``end`` behind the last; of equal ones the smallest."""
    score, back = matrices[0][begin], []
    for m in matrices[1:]:
        each = score[:, None] + m
        back.append(each.argmax(0))
        score = each.max(0)
    path, at = [], end
    for b in reversed(back):
        at = int(b[at])
        path.append(at)
    return path[::-1]


def fit(lines: DataFrame) -> Hmm:
    """(conv_id, place, line, role, is_first) with known roles -> model; rows with other roles are left out.

    ``place`` orders a transcript's lines; the line before is its neighbour in that order.
    Lines are counted in range partitions; of each of these only its counts and its two
    outer lines reach the driver, so a transcript of any length is spread over tasks.
    """
    code = F.coalesce(*[F.when(F.col("role") == r, 2 * k) for k, r in enumerate(ROLES)]) + F.when(F.col("is_first"), 0).otherwise(1)
    known = lines.select("conv_id", "place", observation(F.col("line")).alias("seen"), code.alias("state")).where("state is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, first, last = np.zeros((STATES + 1, STATES, OBSERVATIONS), np.int64), None, None
        for b in batches:
            if not b.num_rows:
                continue
            conv, state, seen = (b.column(c).to_pylist() for c in ("conv_id", "state", "seen"))
            if first is None:
                first = {"conv": conv[0], "state": state[0], "seen": seen[0]}
            else:
                counts[last[1] if conv[0] == last[0] else STATES, state[0], seen[0]] += 1
            before = [s if c == d else STATES for s, c, d in zip(state, conv, conv[1:])]
            np.add.at(counts, (np.array(before, int), np.array(state[1:], int), np.array(seen[1:], int)), 1)
            last = conv[-1], state[-1]
        if first is not None:
            at = np.nonzero(counts)
            yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "first": first, "last": {"conv": last[0], "state": last[1]}, "at": [int(i) for i in np.ravel_multi_index(at, counts.shape)], "n": counts[at].tolist()}], schema=_COUNTS)

    order = ["conv_id", "place", "state", "seen"]
    ordered = known.repartitionByRange("conv_id", "place").sortWithinPartitions(*order).select("conv_id", "state", "seen")
    parts = sorted(ordered.mapInArrow(count, "part int, first struct<conv:long,state:int,seen:int>, last struct<conv:long,state:int>, at array<int>, n array<long>").collect(), key=lambda r: r.part)
    counts, last = np.zeros((STATES + 1, STATES, OBSERVATIONS)), None
    for r in parts:
        np.add.at(counts.ravel(), r["at"], r["n"])
        before = last.state if last is not None and last.conv == r["first"].conv else STATES
        counts[before, r["first"].state, r["first"].seen] += 1
        last = r["last"]
    return Hmm(counts.sum(2), counts.sum(0))


_COUNTS = pa.schema([
    ("part", pa.int32()), ("first", pa.struct([("conv", pa.int64()), ("state", pa.int32()), ("seen", pa.int32())])),
    ("last", pa.struct([("conv", pa.int64()), ("state", pa.int32())])), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())),
])


def _chunks(lines: DataFrame, model, size: int) -> DataFrame:
    """Lines in order, with chunk (ascending along all transcripts), pos in it, and on a chunk's last line its matrix."""
    names = ["conv_id", "place", "line", "seen"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm, number = model.value, TaskContext.get().partitionId() << 33
        conv, rows = None, []

        def closed() -> list[dict]:
            nonlocal number
            m = product(hmm.matrices(np.array([r["seen"] for r in rows])))
            out = [{**r, "chunk": number, "pos": k, "matrix": m.ravel().tolist() if k == len(rows) - 1 else None} for k, r in enumerate(rows)]
            number += 1
            return out

        schema = pa.schema([("conv_id", pa.int64()), ("place", place_type), ("line", pa.string()), ("seen", pa.int32()), ("chunk", pa.int64()), ("pos", pa.int32()), ("matrix", pa.list_(pa.float64()))])
        for b in batches:
            done = []
            for r in b.to_pylist():
                if rows and (r["conv_id"] != conv or len(rows) == size):
                    done += closed()
                    rows = []
                conv = r["conv_id"]
                rows.append(r)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if rows:
            yield pa.RecordBatch.from_pylist(closed(), schema=schema)

    place_type = pa.struct([("turn", pa.int64()), ("text", pa.int64()), ("row", pa.int32())])
    ordered = lines.select(*names).repartitionByRange("conv_id", "place").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(run, "conv_id long, place struct<turn:long,text:long,row:int>, line string, seen int, chunk long, pos int, matrix array<double>")


def parse(lines: DataFrame, hmm: Hmm, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, place, line) -> conv_id, place, line, role, is_first, turn_no, content: one row for each line.

    ``place`` (turn, text, row) orders a transcript's lines. turn_no counts a transcript's
    turns from 1; content: the line without the marker that opens its turn. Null lines are
    empty ones. A null conv_id is a transcript of its own. Repeated rows are lines like
    others. An empty table gives none. Other columns are ignored.
    """
    if chunk < 2:
        raise ValueError("a chunk of fewer than two lines never ends")
    spark = lines.sparkSession
    shared = spark.sparkContext.broadcast(hmm)
    seen = lines.select("conv_id", "place", F.coalesce("line", F.lit("")).alias("line")).withColumn("seen", observation(F.col("line")))
    rows = written(_chunks(seen, shared, chunk), "lines")

    # up: matrices of ever larger parts, until each transcript is one
    order = Window.partitionBy("conv_id").orderBy("chunk")
    level = rows.where("matrix is not null").select("conv_id", "chunk", "matrix").withColumn("nth", F.row_number().over(order) - 1)
    levels = [written(level, "level")]
    while (levels[-1].agg(F.max("nth")).first()[0] or 0) > 0:
        grouped = levels[-1].groupBy("conv_id", F.floor(F.col("nth") / chunk).cast("int").alias("nth")).agg(F.sort_array(F.collect_list(F.struct(F.col("nth").alias("k"), "matrix"))).alias("parts"))
        levels.append(written(grouped.mapInArrow(_multiply, "conv_id long, matrix array<double>, nth int"), "level"))

    # down: states before and behind each part
    ends = levels[-1].mapInArrow(_ends, "conv_id long, nth int, begin int, end int")
    for lower in reversed(levels[:-1]):
        grouped = lower.withColumn("up", F.floor(F.col("nth") / chunk).cast("int")).groupBy("conv_id", "up").agg(F.sort_array(F.collect_list(F.struct(F.col("nth").alias("k"), "matrix"))).alias("parts"))
        ends = ends.withColumnRenamed("nth", "up")
        joined = grouped.join(ends, grouped["conv_id"].eqNullSafe(ends["conv_id"]) & (grouped["up"] == ends["up"])).select(grouped["conv_id"], "parts", "begin", "end")
        ends = joined.mapInArrow(_inside, "conv_id long, nth int, begin int, end int")
    own = levels[0].select(F.col("conv_id").alias("c"), F.col("nth").alias("m"), "chunk")
    borders = own.join(ends, own["c"].eqNullSafe(ends["conv_id"]) & (own["m"] == ends["nth"])).select("chunk", "begin", "end", (F.col("nth") == 0).alias("opens"))
    joined = rows.drop("matrix").join(borders, "chunk").repartition("chunk").sortWithinPartitions("chunk", "pos")
    states = joined.select("conv_id", "place", "line", "seen", "chunk", "pos", "begin", "end", "opens").mapInArrow(_states(shared), "conv_id long, place struct<turn:long,text:long,row:int>, line string, chunk long, pos int, opens boolean, state int")
    states = written(states.withColumn("is_first", (F.col("state") % 2 == 0) | F.col("opens")), "states")
    # turns before a chunk, from one row for each chunk; then those inside it
    begun = states.groupBy("conv_id", "chunk").agg(F.count_if("is_first").alias("n"))
    before = begun.select("chunk", (F.sum("n").over(order) - F.col("n")).alias("before"))
    inside = F.count_if("is_first").over(Window.partitionBy("chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.floor(F.col("state") / 2).cast("int") + 1)
    found = states.withColumn("inside", inside).join(before, "chunk").withColumn("role", role)
    return found.select("conv_id", "place", "line", "role", "is_first", (F.col("before") + F.col("inside")).alias("turn_no"), content(F.col("line"), role, F.col("is_first")).alias("content"))


def turns(parsed: DataFrame) -> DataFrame:
    """From ``parse``: conv_id, turn_no, role, n_lines, text, rendered: one row for each turn.

    text: the turn's lines as they were, less the marker that opened it. rendered:
    behind the role's tag and before an end tag, with ``<|`` in the text written as
    ``<||``, so that no text can look like a tag; a transcript is its turns' concatenation.
    A turn's text is one value, so its length is bounded as any value's is.
    """
    one = parsed.groupBy("conv_id", "turn_no").agg(F.min("role").alias("role"), F.count("*").alias("n_lines"), F.sort_array(F.collect_list(F.struct("place", "content"))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["content"]), "\n")
    shown = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.replace("text", F.lit("<|"), F.lit("<||")), F.lit("<|end|>\n"))
    return one.select("conv_id", "turn_no", "role", "n_lines", text.alias("text")).withColumn("rendered", shown)


def _stack(parts: list[dict]) -> np.ndarray:
    return np.array([p["matrix"] for p in parts]).reshape(-1, STATES + 1, STATES + 1)


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [{"conv_id": r["conv_id"], "matrix": product(_stack(r["parts"])).ravel().tolist(), "nth": r["nth"]} for r in b.to_pylist()]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("conv_id", pa.int64()), ("matrix", pa.list_(pa.float64())), ("nth", pa.int32())]))


_ENDS = pa.schema([("conv_id", pa.int64()), ("nth", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state before each whole transcript, and its best last one."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            end = _stack([r])[0][STATES].argmax()
            out.append({"conv_id": r["conv_id"], "nth": r["nth"], "begin": STATES, "end": int(end)})
        yield pa.RecordBatch.from_pylist(out, schema=_ENDS)


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for r in b.to_pylist():
            inner = states_between(_stack(r["parts"]), r["begin"], r["end"])
            edge = [r["begin"], *inner, r["end"]]
            out += [{"conv_id": r["conv_id"], "nth": p["k"], "begin": edge[k], "end": edge[k + 1]} for k, p in enumerate(r["parts"])]
        yield pa.RecordBatch.from_pylist(out, schema=_ENDS)


def _states(shared):
    """States of a chunk's lines between those at its borders."""

    def run(batches):
        kept, schema = [], None

        def solved(rows: list[dict]) -> list[dict]:
            m = shared.value.matrices(np.array([r["seen"] for r in rows]))
            path = [*states_between(m, rows[0]["begin"], rows[0]["end"]), rows[0]["end"]]
            return [{"conv_id": r["conv_id"], "place": r["place"], "line": r["line"], "chunk": r["chunk"], "pos": r["pos"], "opens": r["opens"] and k == 0, "state": s} for k, (r, s) in enumerate(zip(rows, path))]

        for b in batches:
            schema = pa.schema([*(b.schema.field(n) for n in ("conv_id", "place", "line", "chunk", "pos", "opens")), ("state", pa.int32())])
            *whole, kept = [list(rows) for _, rows in groupby(kept + b.to_pylist(), itemgetter("chunk"))] or [[]]  # the last may go on in the next batch
            yield pa.RecordBatch.from_pylist([x for rows in whole for x in solved(rows)], schema=schema)
        if kept:
            yield pa.RecordBatch.from_pylist(solved(kept), schema=schema)

    return run


# --- the query ------------------------------------------------------------------

#: How raw transcripts name the speakers, by style.
STYLES = [("System: ", "User: ", "Assistant: "), ("Instructions: ", "Human: ", "AI: "), ("### Context: ", "### Instruction: ", "### Response: "), ("[Prompt]: ", "[Q]: ", "[A]: ")]


def raw_lines(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of (conv_id, turn, role, text): lines with a marker where a turn begins, in one style for each transcript.

    One turn in eight has no marker. role and is_first are what a parser should find.
    """
    names = F.element_at(F.array(*[F.array(*map(F.lit, style)) for style in STYLES]), (F.pmod(F.xxhash64("conv_id", F.lit(1)), F.lit(len(STYLES))) + 1).cast("int"))
    number = F.coalesce(*[F.when(F.col("role") == r, k + 1) for k, r in enumerate(ROLES)])
    marked = number.isNotNull() & (F.pmod(F.xxhash64("conv_id", "turn", F.lit(2)), F.lit(8)) != 0)
    marker = F.when(marked, F.element_at(names, F.coalesce(number, F.lit(1)))).otherwise("")
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"), marker.alias("marker"))
    lines = turns.select("*", F.posexplode(F.split("text", "\n", -1)).alias("row", "part"))
    place = F.struct("turn", F.xxhash64("text").alias("text"), "row")
    return lines.select("conv_id", place.alias("place"), F.concat(F.when(F.col("row") == 0, F.col("marker")).otherwise(""), F.col("part")).alias("line"), "role", (F.col("row") == 0).alias("is_first"))


def held_out(conv_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def op10_transcript_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of every conversation's raw transcript; the table's own roles are learned from but for held-out transcripts."""
    lines = raw_lines(table(spark, sf_dir, "conversations"))
    hmm = fit(lines.where(~held_out(F.col("conv_id"))))
    found = turns(parse(lines.select("conv_id", "place", "line"), hmm))
    return found.select("conv_id", "turn_no", held_out(F.col("conv_id")).alias("held_out"), F.col("role").alias("role_pred"), "n_lines", "text", "rendered")
