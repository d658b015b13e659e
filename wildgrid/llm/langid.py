"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts of order 0 to ``ORDER`` counts which byte
followed. With frozen statistics a byte's code length is found at the longest
context that knows it: -log2 of count / (n + distinct), after an escape of
-log2 of distinct / (n + distinct) at each longer known context (method C); bytes
that no context knows cost 8 bits more. A text's score in a language is the exact sum
over its bytes, and the shortest code wins.

Counts cover all labelled rows: each task sums its rows' context counts, and only
those sums are shuffled. Trees are sparse: sorted grams (a context and the byte behind
it) of each order, found by hash. A model's size is bounded: of each language and order
the most frequent grams are kept, ``GRAMS`` at most, and fewer where many languages
would make more than ``CELLS`` numbers in all. Text that needs a rarer one escapes to a
shorter context; nothing else changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, table, written

#: Bytes of the longest context.
ORDER = 4
#: Grams of one order that a language keeps at most, and numbers that all tables hold at most (4 bytes each).
GRAMS, CELLS = 1 << 17, 1 << 24
#: Languages that a model may have at most; more are an error, none is left out.
LANGUAGES = 256
#: Bytes of one language that are counted, and bytes whose code lengths are looked up, at a time.
CHUNK = 1 << 20
#: A score compares texts as if they had so many bytes, and one more code of 8 bits a byte beside the languages'.
SCORED = 8
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_MASK = [(1 << 8 * (k + 1)) - 1 for k in range(ORDER + 1)]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each behind ``ORDER`` spaces, and where the texts' own bytes begin in them."""
    joined = np.frombuffer(b"".join([x for t in texts for x in (b" " * ORDER, t)]), np.uint8)
    return joined, np.cumsum([0, *(len(t) + ORDER for t in texts)])[:-1] + ORDER


def _grams(symbols: np.ndarray) -> np.ndarray:
    """Number of the ORDER + 1 bytes that end at each place from ORDER on."""
    n = len(symbols) - ORDER
    out = np.zeros(max(0, n), np.int64)
    for k in range(ORDER + 1):
        out <<= 8
        out |= symbols[k : k + n]
    return out


def count_grams(labelled: DataFrame) -> DataFrame:
    """(lang, text) -> lang, length, gram, count over whole texts; gram packs ``length`` + 1 bytes, the last one behind its context."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        held: dict[str, tuple[list[bytes], int]] = {}  # texts not yet counted, and their bytes

        def add(lang: str, grams: np.ndarray) -> None:
            new, m = np.unique(grams, return_counts=True)
            sums[lang] = _merged(*sums[lang], new, m) if lang in sums else (new, m)

        def flush(lang: str) -> None:
            symbols, starts = _joined(held.pop(lang)[0])
            inside = np.ones(len(symbols), bool)
            for k in range(1, ORDER + 1):
                inside[starts - k] = False
            add(lang, _grams(symbols)[inside[ORDER:]])

        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text")):
                lang, text = lang.as_py(), text.as_py().encode()
                if len(text) > CHUNK:  # by parts that keep their context
                    text = b" " * ORDER + text
                    for k in range(ORDER, len(text), CHUNK):
                        add(lang, _grams(np.frombuffer(text[k - ORDER : k + CHUNK], np.uint8)))
                    continue
                texts, size = held.get(lang, ([], 0))
                texts.append(text)
                held[lang] = texts, size + len(text)
                if size + len(text) > CHUNK:
                    flush(lang)
        for lang in list(held):
            flush(lang)
        for lang, (keys, n) in sums.items():
            for k in range(ORDER, -1, -1):
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys)), "length": pa.array(np.full(len(keys), k, np.int32)), "gram": pa.array(keys), "n": pa.array(n.astype(np.int64))})
                if k:
                    keys, n = _merged(keys & _MASK[k - 1], n)

    found = labelled.select("lang", "text").mapInArrow(count, "lang string, length int, gram long, n long")
    return found.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))


def _merged(*pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts, keys, counts, ...) -> ascending keys and the sums of their counts."""
    keys, at = np.unique(np.concatenate(pairs[::2]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate(pairs[1::2]), len(keys)).astype(np.int64)


def frequent(counts: DataFrame, grams: int = GRAMS, cells: int = CELLS) -> DataFrame:
    """``counts`` less the rarest grams of each language and length of which there are too many to keep.

    Counts are cut between classes of equal (or, from 1,024 on, nearly equal) counts,
    so no order of grams is needed, only the number of grams in each class.
    """
    exact = F.col("n") < 1024
    kind = F.when(exact, F.col("n")).otherwise(1024 + F.floor(F.log2("n") * 64)).cast("int")
    classes = counts.groupBy("lang", "length", kind.alias("kind")).agg(F.count("*").alias("grams")).collect()  # at most a few thousand a language
    langs = len({r.lang for r in classes})
    most = max(256, min(grams, cells // max(1, (ORDER + 1) * langs * langs)))
    kept: dict[tuple, tuple[int, int]] = {}  # grams kept, least class
    cut = False
    for r in sorted(classes, key=lambda r: -r.kind):
        total, least = kept.get((r.lang, r.length), (0, r.kind))
        if total + r.grams <= most:
            kept[r.lang, r.length] = total + r.grams, r.kind
        else:
            kept[r.lang, r.length] = most + 1, least if total else r.kind + 1
            cut = True
    if not cut:
        return counts
    least = counts.sparkSession.createDataFrame([(*key, k) for key, (_, k) in kept.items()], "lang string, length int, least int")
    return counts.join(F.broadcast(least), ["lang", "length"]).where(kind >= F.col("least")).drop("least")


class Keys:
    """Places of sorted numbers, found by hash: each round has a table of its own for those that lost their slot in the last."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.rounds, left = keys, [], np.arange(len(keys), dtype=np.int32)
        factor = 0x9E3779B97F4A7C15
        while len(left):
            bits = max(4, (4 * len(left)).bit_length())
            slot = self._slot(keys[left], factor, bits)
            table = np.full(1 << bits, -1, np.int32)
            table[slot] = left
            self.rounds.append((factor, bits, table))
            left = left[table[slot] != left]
            factor = factor * 0xD1342543DE82EF95 + 2 & (1 << 64) - 1 | 1

    @staticmethod
    def _slot(numbers: np.ndarray, factor: int, bits: int) -> np.ndarray:
        return (numbers.view(np.uint64) * np.uint64(factor)) >> np.uint64(64 - bits)

    def find(self, numbers: np.ndarray) -> np.ndarray:
        """The place of each number, -1 for those that aren't there."""
        out = np.full(len(numbers), -1, np.int32)
        at, asked = None, numbers
        for factor, bits, table in self.rounds:
            found = table[self._slot(asked, factor, bits)]
            same = (self.keys[found] == asked) & (found >= 0)
            if at is None:
                out[same] = found[same]
                at = np.flatnonzero(~same & (found >= 0))  # an empty slot: nowhere
            else:
                out[at[same]] = found[same]
                at = at[~same & (found >= 0)]
            if not len(at):
                break
            asked = numbers[at]
        return out


class Model:
    """Code lengths in every language: ``bits`` of each known gram of each order, ``escape`` of each known context."""

    def __init__(self, langs: list[str], grams: list[np.ndarray], bits: list[np.ndarray], contexts: list[np.ndarray], escape: list[np.ndarray]):
        self.__setstate__((langs, grams, bits, contexts, escape))

    def __getstate__(self):
        return self.langs, self.grams, self.bits, self.contexts, self.escape

    def __setstate__(self, state):
        self.langs, self.grams, self.bits, self.contexts, self.escape = state
        self.gram_rows, self.context_rows = list(map(Keys, self.grams)), list(map(Keys, self.contexts))  # not shipped

    @classmethod
    def fit(cls, counts) -> Model:
        """``counts``: pandas frame of lang, length, gram, n."""
        langs = sorted(set(counts["lang"].unique()))
        if len(langs) > LANGUAGES:
            raise ValueError(f"{len(langs)} languages; at most {LANGUAGES} can be learned")
        model = cls(langs, [], [], [], [])
        for k in range(ORDER + 1):
            part = counts[counts["length"] == k]
            own = []
            for lang in langs:
                mine = part[part["lang"] == lang].sort_values("gram")
                own.append((mine["gram"].to_numpy(np.int64), mine["n"].to_numpy(np.float64)))
            grams = np.arange(256) if k == 0 else np.unique(np.concatenate([np.zeros(0, np.int64), *(g for g, _ in own)]))
            contexts = np.unique(grams >> 8)
            bits = 8.0 + np.zeros((256, len(langs))) if k == 0 else model.costs(grams, k - 1).astype(np.float64)
            escape = np.zeros((len(contexts), len(langs)), np.float32)
            for j, (g, n) in enumerate(own):
                at = np.searchsorted(contexts, g >> 8)
                total, distinct = np.bincount(at, n, len(contexts)), np.bincount(at, minlength=len(contexts))
                known = total > 0
                escape[known, j] = np.log2((total + distinct)[known]) - np.log2(distinct[known])
                bits[:, j] += escape[np.searchsorted(contexts, grams >> 8), j]
                bits[np.searchsorted(grams, g), j] = np.log2((total + distinct)[at]) - np.log2(n)
            model = cls(langs, [*model.grams, grams], [*model.bits, bits.astype(np.float32)], [*model.contexts, contexts], [*model.escape, escape])
        return model

    def costs(self, grams: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of each gram's last byte in each language."""
        at = None
        for k in range(order, -1, -1):
            own = grams & _MASK[k]
            row = self.gram_rows[k].find(own)
            new = np.flatnonzero(row < 0)
            if at is None:
                out = self.bits[k][row] if len(self.bits[k]) else np.zeros((len(row), len(self.langs)), np.float32)
                out[new] = 0
                at = new
            else:
                known = row >= 0
                out[at[known]] += self.bits[k][row[known]]
                at = at[new]
            if not len(at):
                break
            grams = grams[new]
            context = self.context_rows[k].find(own[new] >> 8)
            known = context >= 0
            out[at[known]] += self.escape[k][context[known]]
        return out

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.langs)))
        first, size = 0, 0
        for k, t in enumerate([*texts, None]):
            if t is None or size + len(t) > CHUNK and k > first:
                if k > first:
                    out[first:k] = self._lengths(texts[first:k])
                first, size = k, 0
            size += 0 if t is None else len(t)
        return out

    def _lengths(self, texts: list[bytes]) -> np.ndarray:
        if len(texts) == 1 and len(texts[0]) > CHUNK:  # a very long text, by parts that keep their context
            t, sums = b" " * ORDER + texts[0], 0
            for k in range(ORDER, len(t), CHUNK):
                sums = sums + self.costs(_grams(np.frombuffer(t[k - ORDER : k + CHUNK], np.uint8))).sum(axis=0, dtype=np.float64)
            return sums[None]
        symbols, starts = _joined(texts)
        cost = self.costs(_grams(symbols))
        ends = starts + [len(t) for t in texts]
        sums = np.zeros((len(cost) + 1, cost.shape[1]))
        np.cumsum(cost, axis=0, dtype=np.float64, out=sums[1:])
        return sums[ends - ORDER] - sums[starts - ORDER]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score; ``und`` and 0 without a letter.

        score: the language's share of 2^-(``SCORED`` times the bits a byte) over all languages
        and the code of 8 bits a byte. So texts that no language describes well score low, at any length.
        """
        asked = [k for k, t in enumerate(texts) if t and _LETTER.search(t)] if self.langs else []
        lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if asked:
            raw = [texts[k].encode() for k in asked]
            bits = np.round(self.lengths(raw), 6)
            best = bits.argmin(axis=1)  # on a tie the first in alphabetical order
            rate = np.column_stack([bits / np.array([len(t) for t in raw])[:, None], np.full(len(raw), 8.0)]) * SCORED
            share = 1 / np.exp2(np.maximum(-1000, rate[np.arange(len(best)), best][:, None] - rate)).sum(axis=1)
            for k, b, s in zip(asked, best, np.minimum(1.0, share)):
                lang[k], score[k] = self.langs[b], s
        return lang, score


def train(labelled: DataFrame) -> Model:
    """A model of (lang, text); rows with a null in either are left out. What is collected is bounded by ``GRAMS`` and ``CELLS``."""
    known = labelled.select("lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = written(count_grams(known), "grams")
    model = Model.fit(frequent(counts).toArrow().to_pandas(strings_to_categorical=True))
    forget(counts)
    return model


def identify(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with two columns, the language and its score. Null, empty and letterless texts are ``und`` with 0; so are all, if nothing was learned.

    Columns of ``docs`` that are called like the new ones (``names``) are refused; all others come through as they are.
    Equal texts have equal results; repeated rows stay.
    """
    if clash := {n.lower() for n in names} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} clash with those that are added")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                lang, score = shared.value.predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang), pa.array(score)], names=[*part.schema.names, *names])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(predict, f"{ddl}, `{names[0]}` string, `{names[1]}` double")


def held_out(doc_id: Column) -> Column:
    """One of four parts of the documents; a null id is never held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
