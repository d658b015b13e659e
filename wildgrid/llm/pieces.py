"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi.

The automaton holds all pieces. Read once over a text, it reports at each place every
piece that ends there (its own output and those behind the output links); each
relaxes the best score of the place behind it from that before it. The path with the
largest sum of the model's scores wins; of equal sums the one whose last piece is the
longest, place by place. A character that no piece covers costs ``UNKNOWN`` below the
least score and is written as byte pieces, so decoding gives every text back. A space
is written as U+2581, with one before the text; a U+2581 in the text itself is
written in bytes, which keeps it apart.

No piece goes on over the border before a space that follows another character, so
best paths of words are parts of the best path of the text: words are encoded once
for each worker, in a memo of bounded size (long words aren't kept).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SPACE = "▁"
UNKNOWN = 10.0
#: Words that one worker keeps with their ids, and the longest such word: both bound its memory.
MEMO, LONG = 450_000, 64
#: A word with the spaces before it. The mark in a text stands for itself in bytes, so it is part of a word.
_WORD = re.compile(f"{SPACE}*[^{SPACE}]*")
#: Stands for U+2581 of the text while spaces are written so; no valid text holds a lone surrogate.
_MARK = "\udfff"


class Pieces:
    """Pieces and scores of a SentencePiece model file, whatever its own algorithm is."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = [i for i in range(len(self.pieces)) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)]
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(len(self.pieces)) if sp.is_byte(i)}
        plain = sorted(set(range(len(self.pieces))) - set(special) - set(self.bytes.values()))
        self.special, self.of_byte = set(special), {i: b for b, i in self.bytes.items()}
        self.scores = {i: sp.get_score(i) for i in plain}
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), self.scores[i], i))
        self.automaton.make_automaton()
        if any(SPACE in p.lstrip(SPACE) for p in (self.pieces[i] for i in plain)):
            raise ValueError("a piece goes on over a space; texts can't be cut at words")
        if len(self.bytes) != 256:
            raise ValueError("a model with byte pieces is expected")

    def viterbi(self, text: str) -> tuple[list[int], float]:
        """Ids and score of the best path over ``text``, already written with U+2581."""
        n = len(text)
        best, back = [0.0] + [None] * n, [None] * (n + 1)
        done = 0

        def settle(to: int) -> None:
            """Places before ``to`` that no piece reaches come from the place before as unknown characters."""
            nonlocal done
            while done < to:
                done += 1
                step = best[done - 1] + self.unknown
                if best[done] is None or step > best[done]:
                    best[done], back[done] = step, (1, -1)

        for end, (size, score, i) in self.automaton.iter(text):
            settle(end)
            total = best[end + 1 - size] + score
            old = best[end + 1]
            if old is None or total > old or total == old and size > back[end + 1][0]:
                best[end + 1], back[end + 1] = total, (size, i)
        settle(n)
        ids, at = [], n
        while at:
            size, i = back[at]
            if i < 0:
                raw = (SPACE if text[at - 1] == _MARK else text[at - 1]).encode("utf-8", "surrogatepass")
                ids += [self.bytes[b] for b in reversed(raw)]
            else:
                ids.append(i)
            at -= size
        return ids[::-1], best[n]

    def decode(self, ids) -> str:
        """The text of ids from ``Encoder``; control pieces have none."""
        out = bytearray()
        for i in ids:
            if (b := self.of_byte.get(i)) is not None:
                out.append(b)
            elif i not in self.special:
                out += self.pieces[i].replace(SPACE, " ").encode()
        return out.decode("utf-8", "replace").removeprefix(" ")


class _Words(dict):
    """Ids of words behind one space, found when they are first asked for."""

    def __init__(self, model: Pieces):
        self.model = model

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.model.viterbi(SPACE + word)[0]).tobytes()
        if len(word) <= LONG:
            self[word] = ids
        return ids


class Encoder:
    """Whole texts by their words. The memo holds ids alone; a text's score is the sum over its ids."""

    def __init__(self, path: str, memo: int = MEMO):
        self.model, self.limit = Pieces(path), memo
        self.words = _Words(self.model)
        self.scores = np.zeros(len(self.model.pieces))
        for i, score in self.model.scores.items():
            self.scores[i] = score
        for b, i in self.model.bytes.items():  # an unknown character counts once, at its first byte
            self.scores[i] = 0.0 if 0x80 <= b < 0xC0 else self.model.unknown

    def __call__(self, text: str) -> tuple[bytes, float]:
        """Ids (32 bits, little-endian) and score. The empty text has no ids."""
        if not text:
            return b"", 0.0
        if SPACE in text:
            text = text.replace(SPACE, _MARK)
        if "  " in text or text[0] == " ":
            parts = [w[1:] for w in _WORD.findall(SPACE + text.replace(" ", SPACE))[:-1]]  # the last match is empty
        else:
            parts = text.split(" ")
        if len(self.words) > self.limit:
            self.words.clear()
        ids = b"".join(map(self.words.__getitem__, parts))
        return ids, float(self.scores[np.frombuffer(ids, np.uint32)].sum())


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _refuse(df: DataFrame, names: set[str]) -> None:
    if clash := names & {c.lower() for c in df.columns}:
        raise ValueError(f"columns {sorted(clash)} clash with those that are added")


def encode(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``df`` with ids (array<int>) and piece_score. Null texts have null ids and score, empty ones none and 0."""
    _refuse(df, {"ids", "piece_score"})
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                got = [(None, None) if t is None else enc(t) for t in part.column(at).to_pylist()]
                sizes = [None if ids is None else len(ids) // 4 for ids, _ in got]
                ends, total = array("i", [0]), 0
                for n in sizes:
                    total += n or 0
                    ends.append(total)
                flat = pa.Array.from_buffers(pa.int32(), total, [None, pa.py_buffer(b"".join([ids or b"" for ids, _ in got]))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=pa.array([n is None for n in sizes]))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array([s for _, s in got], pa.float64())], names=[*part.schema.names, "ids", "piece_score"])

    return df.mapInArrow(run, f"{_ddl(df)}, ids array<int>, piece_score double")


def decode(df: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``df`` with decoded, the text of its ids; null ids have a null text."""
    _refuse(df, {"decoded"})
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _encoder(model).model
        texts = pieces_text(pieces)
        for b in batches:
            for k in range(0, b.num_rows, 500):
                part = b.slice(k, 500)
                column = part.column(at)
                out = []
                for i in range(len(column)):
                    x = column[i]
                    out.append(texts(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else None)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], names=[*part.schema.names, "decoded"])

    return df.mapInArrow(run, f"{_ddl(df)}, decoded string")


def pieces_text(pieces: Pieces):
    """``Pieces.decode`` with every piece's bytes looked up."""
    raw = [bytes([pieces.of_byte[i]]) if i in pieces.of_byte else b"" if i in pieces.special else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces.pieces)]
    get = raw.__getitem__
    return lambda ids: b"".join(map(get, ids)).decode("utf-8", "replace").removeprefix(" ")


def op5_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding them gives the text back."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    found = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model), model)
    joined = F.crc32(F.encode(F.array_join(F.transform("ids", lambda i: i.cast("string")), " "), "UTF-8"))
    n = F.when(F.col("ids").isNotNull(), F.size("ids").cast("long"))
    return found.select("doc_id", n.alias("n_pieces"), joined.alias("ids_crc32"), F.round("piece_score", 3).alias("piece_score"), F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))
