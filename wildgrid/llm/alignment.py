"""Alignment of the token sequences that two tokenizers give one text.

A is a byte-level vocabulary of the tokenizers library over space + text, B a sentencepiece
model over the text (it adds the space itself), so both spell the same bytes. Tokens whose byte ranges overlap
are linked; where tokens of both end at one byte, a cut ends a group.

The merge is one loop for a whole batch: a vector of A pointers and one of B pointers stand at the current
tokens of all sequences; each step emits a link for every sequence, a cut where
both tokens end, and advances whichever ends first (both at a cut). Finished sequences
are compacted away. Long documents enter as several sequences, cut at spaces where both
tokenizers always begin a token, so one long document doesn't keep the loop alone.

How many documents hold an id pair is counted by Spark over the stored links. Pairs of
one document alone need no lookup, so only the others meet the links again.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bitplanes import _BYTES, _CUT, _ODD, _cuts
from .common import scratch, table

#: Bytes of text that are merged at a time, and chunks of text in one sequence.
WINDOW, CHUNKS = 1 << 21, 64
#: Chunks that one worker keeps with their ids, and the longest of these: both bound its memory.
MEMO, LONG = 400_000, 64
#: Id pairs of several documents that are broadcast at most; beyond it they meet the links in a shuffled join.
PAIRS = 1_000_000

# --- texts to ids -------------------------------------------------------------


def _bytes_of_a(tokenizer) -> list[bytes]:
    """What each id of a byte-level vocabulary spells."""
    back = {chr(_BYTES.get(b, b)): b for b in range(256)}
    out = [b""] * tokenizer.get_vocab_size()
    for piece, i in tokenizer.get_vocab().items():
        out[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()
    return out


def _bytes_of_b(model) -> list[bytes]:
    """What each id of a sentencepiece model spells."""
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]


class Pair:
    """Both tokenizers behind one memo of chunks.

    Texts are cut at single spaces between two other characters. The first always starts a new
    piece there, and so does the second if none of its pieces has a space behind another character
    (looked up here; with another model texts stay whole). Chunks that a window of texts has and the memo
    lacks are encoded in one call, as one text. Strings of special tokens are plain text.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes, self.b_bytes = _bytes_of_a(self.a), _bytes_of_b(self.b)
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        pieces = (self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.cuts = _cuts(json.loads(self.a.to_str())) and not any("▁" in p for p in pieces)
        # chunks of late, and those of before: what is asked for again moves from these to those
        self.memo: dict[str, tuple[bytes, bytes] | None] = {}
        self.old: dict[str, tuple[bytes, bytes] | None] = {}
        self.decimals = _decimals(max(len(self.a_bytes), len(self.b_bytes)))

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, if both spell space + text."""
        said = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        if b"".join([self.a_bytes[i] for i in a]) != said or b"".join([self.b_bytes[i] for i in b]) != said:
            return None
        return np.array(a, np.uint32), np.array(b, np.uint32)

    def _chunks(self, chunks: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """The ids of each chunk (None where a tokenizer doesn't spell it), found as one text."""
        ids = self._whole(" ".join(chunks))
        if ids is None:
            if len(chunks) == 1:
                return {chunks[0]: None}
            half = len(chunks) // 2
            return self._chunks(chunks[:half]) | self._chunks(chunks[half:])
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        sides = []
        for i, size in zip(ids, (self.a_size, self.b_size)):
            to = np.searchsorted(np.cumsum(size[i]), ends, "right") * 4
            raw, to = i.tobytes(), to.tolist()
            sides.append([raw[x:y] for x, y in zip([0, *to], to)])
        return dict(zip(chunks, zip(*sides)))

    def documents(self, texts: list[str]) -> list[list[tuple[bytes, bytes]]]:
        """Of each text the ids of both for consecutive parts, each part beginning a token of both; none if the bytes differ."""
        if not self.cuts:
            ids = [self._whole(t) if t else None for t in texts]
            return [[(x[0].tobytes(), x[1].tobytes())] if x else [] for x in ids]
        if len(self.memo) > MEMO // 2:
            self.memo, self.old = {}, self.memo
        odd = lambda t: "  " in t or " \n" in t or "\n " in t or t[:1] == " " or t[-1:] == " " or _ODD.search(t)
        cut = [_CUT.split(t) if odd(t) else t.split(" ") for t in texts]
        known = [list(map(self.memo.get, chunks)) for chunks in cut]
        wanted = {c for chunks, found in zip(cut, known) if None in found for c, x in zip(chunks, found) if x is None}
        wanted.discard("")
        new = {c: self.old[c] for c in wanted & self.old.keys()}
        wanted -= new.keys()
        # a chunk with spaces at an end isn't cut from its neighbours as one text, nor is one that B spells otherwise
        apart = [c for c in wanted if c.strip() != c or "▁" in c or len(c) > LONG]
        new |= {c: self._chunks([c])[c] for c in apart}
        if together := list(wanted.difference(apart)):
            new |= self._chunks(together)
        self.memo |= {c: x for c, x in new.items() if len(c) <= LONG}
        out = []
        for text, chunks, found in zip(texts, cut, known):
            if not text:
                out.append([])
                continue
            if None in found:
                found = [x or new.get(c) for x, c in zip(found, chunks)]
                if None in found:  # a chunk isn't spelt
                    ids = self._whole(text)
                    out.append([tuple(x.tobytes() for x in ids)] if ids else [])
                    continue
            a, b = zip(*found)
            out.append([(b"".join(a[k : k + CHUNKS]), b"".join(b[k : k + CHUNKS])) for k in range(0, len(a), CHUNKS)])
        return out


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(a_path: str, b_path: str) -> Pair:
    """One for each worker process and pair of files."""
    if (a_path, b_path) not in _pairs:
        _pairs[a_path, b_path] = Pair(a_path, b_path)
    return _pairs[a_path, b_path]


# --- the merge ----------------------------------------------------------------


def merge(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, a_stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) of all sequences, and which of them are cuts.

    a_end, b_end: the byte at which each token ends, counted over all sequences one after another; a_first, b_first, a_stop:
    where each sequence's tokens begin and those of A stop. Both sides of a sequence end at one byte.
    """
    links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    some = a_first < a_stop
    i, j, stop = a_first[some], b_first[some], a_stop[some]
    while len(i):
        a, b = a_end[i], b_end[j]
        links.append((i, j, a == b))
        i, j = i + (a <= b), j + (b <= a)
        alive = i < stop
        if not alive.all():
            i, j, stop = i[alive], j[alive], stop[alive]
    return tuple(np.concatenate(x) for x in zip(*links)) if links else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to n - 1 as rows of bytes with one place to spare, and their numbers."""
    size = np.array([len(str(k)) for k in range(n)])
    return np.array([list(str(k).encode().ljust(len(str(n)) + 1)) for k in range(n)], np.uint8), size


def written_groups(decimals: tuple[np.ndarray, np.ndarray], a_ids: np.ndarray, b_ids: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3;`` over all groups, and where each group ends in them. *_last: tokens that end a group."""
    a_group, b_group = (np.cumsum(x) - x for x in (a_last, b_last))
    a_before, b_before = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (a_last, b_last))  # tokens before each group
    place = np.concatenate([np.arange(len(a_ids)) + b_before[a_group], np.arange(len(b_ids)) + a_before[b_group + 1]])
    ids, mark = np.empty(len(place), np.int32), np.empty(len(place), np.uint8)
    ids[place] = np.concatenate([a_ids, b_ids])
    mark[place] = np.concatenate([np.where(a_last, ord("|"), ord(",")), np.where(b_last, ord(";"), ord(","))])
    digits, sizes = decimals
    size, cells = sizes[ids], digits[ids]
    cells[np.arange(len(ids)), size] = mark
    out = cells[np.arange(digits.shape[1])[None] <= size[:, None]]
    return out, np.cumsum(size + 1)[mark == ord(";")]


class Batch:
    """Everything about the documents of one batch, from their sequences of ids."""

    def __init__(self, pair: Pair, documents: list[list[tuple[bytes, bytes]]]):
        self.decimals = pair.decimals
        sequences = [s for d in documents for s in d]
        n = len(documents)
        self.doc_of = np.repeat(np.arange(n), list(map(len, documents)))
        self.a, self.b = (np.frombuffer(b"".join([s[k] for s in sequences]), np.uint32).astype(np.int64) for k in (0, 1))
        a_len, b_len = (np.array([len(s[k]) // 4 for s in sequences], np.int64) for k in (0, 1))
        a_stop, b_stop = np.cumsum(a_len), np.cumsum(b_len)
        self.a_end, self.b_end = np.cumsum(pair.a_size[self.a]), np.cumsum(pair.b_size[self.b])
        self.i, self.j, self.cut = merge(self.a_end, self.b_end, a_stop - a_len, b_stop - b_len, a_stop)
        self.a_doc = np.repeat(self.doc_of, a_len)
        count = lambda x: np.bincount(x, minlength=n)
        self.n_a, self.n_b = (np.bincount(self.doc_of, x, n).astype(np.int64) for x in (a_len, b_len))
        link_doc = self.a_doc[self.i]
        self.n_links, self.n_groups = count(link_doc), count(link_doc[self.cut])
        # distinct pairs of each document, with their occurrences
        self.kinds = len(pair.a_bytes) * len(pair.b_bytes)
        key, times = np.unique(link_doc * self.kinds + self.a[self.i] * len(pair.b_bytes) + self.b[self.j], return_counts=True)
        self.pair, self.times = key % self.kinds, times
        self.n_pairs = count(key // self.kinds)

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups; empty without tokens."""
        a_last, b_last = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        a_last[self.i[self.cut]], b_last[self.j[self.cut]] = True, True
        text, ends = written_groups(self.decimals, self.a, self.b, a_last, b_last)
        groups = np.cumsum(self.n_groups)
        stop = np.concatenate([[0], ends])[groups]
        start = np.concatenate([[0], stop[:-1]])
        raw = text.tobytes()
        return [hashlib.sha256(raw[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(start.tolist(), stop.tolist())]

    def spans(self) -> list[pa.Array]:
        """a_ids, b_ids, and cuts: byte offsets in space + text at which groups end."""
        lists = lambda x, n: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(x))
        ends = np.sort(self.a_end[self.i[self.cut]])
        size = np.concatenate([[0], self.a_end])[np.cumsum(self.n_a)]
        before = np.concatenate([[0], size[:-1]])
        return [lists(self.a.astype(np.int32), self.n_a), lists(self.b.astype(np.int32), self.n_b), lists(ends - np.repeat(before, self.n_groups), self.n_groups)]


# --- Spark --------------------------------------------------------------------

_LINKS = pa.struct([("pair", pa.int64()), ("n", pa.int32())])
ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<struct<pair:long,n:int>>"
SPANS = "a_ids array<int>, b_ids array<int>, cuts array<long>"


def aligned(docs: DataFrame, a_path: str, b_path: str, spans: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) -> one row each: counts, the digest of the groups, and the distinct linked pairs with their occurrences.

    pair: A's id times B's number of ids, plus B's id. ``spans`` adds both sequences and the cuts' byte offsets. Null
    and empty texts, and those that a tokenizer doesn't spell byte by byte, have no tokens. Repeated rows each give a row.
    ``row`` numbers the rows; write the result before using it twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = pair_of(a_path, b_path), TaskContext.get().partitionId() << 33
        ids: list = []
        held: list[str] = []

        def emit() -> pa.RecordBatch:
            nonlocal row
            found = Batch(pair, pair.documents(held))
            links = pa.StructArray.from_arrays([pa.array(found.pair), pa.array(found.times.astype(np.int32))], fields=list(_LINKS))
            links = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(found.n_pairs)]), pa.int32()), links)
            out = [pa.array(np.arange(row, row + len(ids))), pa.array(ids, pa.int64()), *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(found.digests(), pa.string()), links]
            row += len(ids)
            names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
            return pa.RecordBatch.from_arrays(out + (found.spans() if spans else []), names=names + ["a_ids", "b_ids", "cuts"] * spans)

        size = 0
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                text = text.as_py() or ""
                ids.append(doc_id)
                held.append(text)
                size += len(text) + 64
                if size > WINDOW:
                    yield emit()
                    ids, held, size = [], [], 0
        if ids:
            yield emit()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, ALIGNED + (", " + SPANS) * spans)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, documents) over the rows of ``aligned``."""
    return found.select(F.explode("links").alias("link")).groupBy("link.pair").agg(F.count("*").alias("documents"))


def scored(found: DataFrame, b_ids: int, pairs: int = PAIRS) -> DataFrame:
    """Rows of a written ``aligned`` table with n_best and count_sum; ``b_ids``: B's number of ids."""
    spark, path = found.sparkSession, scratch(found.sparkSession, "pair-counts")
    pair_counts(found).write.parquet(path)
    counts = spark.read.schema("pair long, documents long").parquet(path)
    several = counts.where("documents > 1")
    if several.count() <= pairs:
        several = F.broadcast(several)
    first = (F.col("pair") / b_ids).cast("int")
    # one row for each id of A: its number is the vocabulary's
    highest = F.broadcast(counts.groupBy(first.alias("a")).agg(F.max("documents").alias("highest")))
    lines = found.select("row", F.explode("links").alias("link")).select("row", "link.pair", "link.n").join(several, "pair", "left")
    lines = lines.withColumn("documents", F.coalesce("documents", F.lit(1))).withColumn("a", first).join(highest, "a")
    sums = lines.groupBy("row").agg(F.sum(F.when(F.col("documents") == F.col("highest"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("documents")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return found.join(sums, "row", "left").withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})


def op11_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    import sentencepiece

    a, b = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    path = scratch(spark, "aligned")
    aligned(table(spark, sf_dir, "documents"), a, b).write.option("compression", "zstd").parquet(path)
    found = scored(spark.read.schema(ALIGNED).parquet(path), sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size())
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
