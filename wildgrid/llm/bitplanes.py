"""Token ids as zstandard-compressed bit or byte planes with a chunk index.

Format: documents in ascending ``doc_id`` order are dealt into shards (range
partitions); the ids of a shard form one stream that is cut into blocks of
``block`` ids. A block's ids are transposed into planes (all bits, or all bytes,
of one weight together), each plane is compressed on its own, and
the planes are laid behind a small header. One row of the stored table holds one
block; the other columns of that row are the chunk index: shard, block number,
first id, number of ids, checksum, and the documents that lie in it. Spark's own
writer commits the files, so lost executors and repeated tasks leave no trace.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, table

BLOCK = 1 << 16
#: Distinct chunks of text that one worker keeps with their ids, and the longest such chunk: both bound its memory.
MEMO, LONG = 1_000_000, 64
HEAD = struct.Struct("<4sBBxxI")
MAGIC = b"PLN1"
MODES = ("byte", "bit")

_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("off", pa.int64()), ("n", pa.int64())]))
_BLOCKS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("crc32", pa.int64()), ("data", pa.binary()), ("docs", _DOCS)])
BLOCKS_DDL = "shard int, block int, first long, n_ids int, crc32 long, data binary, docs array<struct<doc_id:long,row:long,start:long,n_tokens:long,off:long,n:long>>"


# --- planes -------------------------------------------------------------------


def encode_block(ids: np.ndarray, mode: str = "byte", level: int = 3) -> bytes:
    """One block: header, the planes' lengths, the compressed planes."""
    ids = np.ascontiguousarray(ids, "<u4")
    top = int(ids.max()) if len(ids) else 0
    if mode == "byte":
        planes = ids.view(np.uint8).reshape(-1, 4).T[: max(1, (top.bit_length() + 7) // 8)]
    else:
        planes = [np.packbits((ids >> b & 1).astype(np.uint8)) for b in range(max(1, top.bit_length()))]
    pack = zstandard.ZstdCompressor(level=level).compress
    parts = [pack(np.ascontiguousarray(p).tobytes()) for p in planes]
    return HEAD.pack(MAGIC, MODES.index(mode), len(parts), len(ids)) + struct.pack(f"<{len(parts)}I", *map(len, parts)) + b"".join(parts)


def decode_block(data: bytes) -> np.ndarray:
    magic, mode, count, n = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of planes")
    at = HEAD.size + 4 * count
    unpack, out = zstandard.ZstdDecompressor().decompress, np.zeros((n, 4), np.uint8)
    ids = out.view("<u4").ravel()
    for k, size in enumerate(struct.unpack_from(f"<{count}I", data, HEAD.size)):
        plane = np.frombuffer(unpack(data[at : at + size], max_output_size=n), np.uint8)
        at += size
        if MODES[mode] == "byte":
            out[:, k] = plane
        else:
            ids |= np.unpackbits(plane, count=n).astype("<u4") << k
    return ids


# --- text to ids --------------------------------------------------------------

_CUT = re.compile(r"(?<=\S) (?=\S)")
#: White space but space and line end; a text with none of it, and no space beside another, is cut at every space.
_ODD_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
_ODD = re.compile(f"[{re.escape(_ODD_SPACES)}]")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"(?:[{_LETTERS}]++|[.,;:!?]++|\n(?=\S))++")
#: How a byte-level vocabulary writes each byte: visible Latin-1 characters stand for themselves, the others follow from 256.
_SEEN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SEEN)}
_PIECE = re.compile(rf"[{_LETTERS}]+|[.,;:!?]+|\n")


def _visible(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_BYTES)


class _Chunks(dict):
    """Ids of chunks that follow a space, found when they are first asked for."""

    def __init__(self, tokenizer):
        self.tokenizer, self.inner = tokenizer, {}  # inner: pieces that follow no space

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            ids = self.piece("Ġ" + chunk)
        elif _PLAIN.fullmatch(chunk):
            head, *more = _PIECE.findall(chunk)
            ids = self.get(head) or self.kept(self, head, self.piece("Ġ" + _visible(head)))
            if more:
                ids += self.inside(more)
        else:
            ids = self.whole(" " + chunk)
        if len(chunk) <= LONG:
            self[chunk] = ids
        return ids

    def first(self, chunk: str) -> bytes:
        """Ids of the chunk that a text begins with."""
        return self.inside(_PIECE.findall(chunk)) if _PLAIN.fullmatch(chunk) else self.whole(chunk)

    def inside(self, pieces: list[str]) -> bytes:
        inner = self.inner
        return b"".join([inner.get(p) or self.kept(inner, p, self.piece(_visible(p))) for p in pieces])

    @staticmethod
    def kept(memo: dict, piece: str, ids: bytes) -> bytes:
        if len(piece) <= LONG:
            memo[piece] = ids
        return ids

    def piece(self, text: str) -> bytes:
        """Ids of one piece of the pre-tokenizer, straight from the model."""
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def _cuts(settings: dict) -> bool:
    """Whether a tokenizer's file has the byte-level pieces, and nothing beside them, that cutting at spaces relies on."""
    before, model = settings["pre_tokenizer"] or {}, settings["model"]
    plain = settings["normalizer"] is None and settings["post_processor"] is None and settings["truncation"] is None and settings["padding"] is None
    pieces = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    words = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    return plain and pieces and words and not any(t["normalized"] for t in settings["added_tokens"])


class Encoder:
    """The tokenizers library behind a memo of chunks.

    The byte-level pre-tokenizer always starts a new piece at a single space between
    two other characters, so a text may be cut there and each chunk encoded alone.
    Chunks of Latin letters, plain marks and single line ends are cut further at
    the borders between these, where it starts new pieces too. Texts that hold an
    added token are not cut, and with a file whose settings are others (``_cuts``) none
    are. Each text's ids are those of ``encode(text, add_special_tokens=False)``.
    """

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.chunks, self.limit = _Chunks(tokenizer), memo
        self.cuts = _cuts(json.loads(tokenizer.to_str()))

    def __call__(self, texts: list[str]) -> list[bytes]:
        chunks, out = self.chunks, []
        get = chunks.__getitem__
        for t in texts:
            if len(chunks) > self.limit or len(chunks.inner) > self.limit:
                chunks.clear()
                chunks.inner.clear()
            if not self.cuts or any(a in t for a in self.added):
                out.append(chunks.whole(t))
                continue
            if "  " in t or " \n" in t or "\n " in t or t[:1] == " " or t[-1:] == " " or _ODD.search(t):
                parts = _CUT.split(t)
            else:
                parts = t.split(" ")
            head = chunks.first(parts.pop(0))
            out.append(head + b"".join(map(get, parts)))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process and tokenizer."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# --- write and read -----------------------------------------------------------


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, block: int = BLOCK, mode: str = "byte", slice_rows: int = 500) -> None:
    """Encode ``docs`` (doc_id, text) and write all ids to ``path`` in ascending doc_id order.

    A null text counts as empty (its document holds the end id alone); null ids come
    first; rows of one id are ordered by their text's hash, and such a group is split
    over shards like any other range. Repeated rows are each written. An empty table
    writes an empty one. Other columns are ignored.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, end = encoder(tokenizer), TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        held, first, number, row = np.empty(0, "<u4"), 0, 0, 0
        at, docs_ = 0, []  # documents not yet wholly written: id, row, start, n

        def emit(ids: np.ndarray) -> pa.RecordBatch:
            nonlocal first, number, docs_
            last = first + len(ids)
            inside = [(d, r, s, n, max(0, first - s), min(last, s + n) - max(first, s)) for d, r, s, n in docs_ if s < last]
            docs_ = [x for x in docs_ if x[2] + x[3] > last]
            out = {"shard": shard, "block": number, "first": first, "n_ids": len(ids), "crc32": zlib.crc32(ids.tobytes()), "data": encode_block(ids, mode), "docs": [dict(zip(("doc_id", "row", "start", "n_tokens", "off", "n"), x)) for x in inside]}
            first, number = last, number + 1
            return pa.RecordBatch.from_pylist([out], schema=_BLOCKS)

        for batch in batches:
            for k in range(0, batch.num_rows, slice_rows):
                part = batch.slice(k, slice_rows)
                coded = enc([t or "" for t in part.column("text").to_pylist()])
                for d, b in zip(part.column("doc_id").to_pylist(), coded):
                    n = len(b) // 4 + 1
                    docs_.append((d, row, at, n))
                    at, row = at + n, row + 1
                held = np.concatenate([held, np.frombuffer(b"".join([x for b in coded for x in (b, end)]), "<u4")])
                while len(held) >= block:
                    yield emit(held[:block])
                    held = held[block:]
        if len(held):
            yield emit(held)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = slim.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(pack, BLOCKS_DDL).write.parquet(path)


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """The index alone: one row for each block, with the place of its first id among all ids."""
    blocks = spark.read.schema(BLOCKS_DDL).parquet(path).select("shard", "block", "first", "n_ids", "crc32")
    return blocks.join(shard_starts(spark, path), "shard").withColumn("position", F.col("shard_start") + F.col("first")).drop("shard_start")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each shard. One row a shard, so the running sum is over a small table."""
    from pyspark.sql import Window

    totals = spark.read.schema(BLOCKS_DDL).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents from the stored planes: doc_id, start, n_tokens, ids_crc32 (and ids, little-endian).

    Blocks are decoded where they lie. Only pieces of documents that cross a block's
    border carry their ids to be joined; the others are complete at once.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids, rows = decode_block(b["data"]), []
                if zlib.crc32(ids.tobytes()) != b["crc32"]:
                    raise ValueError(f"shard {b['shard']}, block {b['block']}: checksum differs")
                for d in b["docs"]:
                    lo = d["start"] + d["off"] - b["first"]
                    raw = ids[lo : lo + d["n"]].tobytes()
                    rows.append({"shard": b["shard"], **d, "crc": zlib.crc32(raw), "raw": raw if with_ids or d["n"] < d["n_tokens"] else None})
                yield pa.RecordBatch.from_pylist(rows, schema=pieces)

    pieces = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("off", pa.int64()), ("n", pa.int64()), ("crc", pa.int64()), ("raw", pa.binary())])
    blocks = spark.read.schema(BLOCKS_DDL).parquet(path).select("shard", "first", "crc32", "data", "docs")
    found = blocks.mapInArrow(unpack, "shard int, doc_id long, row long, start long, n_tokens long, off long, n long, crc long, raw binary")
    part = F.struct("off", "crc", "raw")
    whole = found.groupBy("shard", "row").agg(F.first("doc_id").alias("doc_id"), F.first("start").alias("start"), F.first("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(part)).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["raw"]))
    crc = F.when(F.size("parts") == 1, F.element_at("parts", 1)["crc"]).otherwise(F.crc32(joined))
    out = [F.col("doc_id"), (F.col("shard_start") + F.col("start")).alias("start"), "n_tokens", crc.alias("ids_crc32")]
    return whole.join(shard_starts(spark, path), "shard").select(*out, *([joined.alias("ids")] if with_ids else []))


def op3_bit_plane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "op3")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path)
