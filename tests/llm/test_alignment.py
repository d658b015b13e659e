"""Alignment of two tokenizers against the libraries and loops over byte offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from wildgrid.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def visible() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary, by its published rule."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


BACK = visible()


def brute(text, libraries):
    """(a ids, b ids, links, groups) with links as pairs of ids."""
    a, b = libraries
    none = [], [], [], []
    if not text:
        return none
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_raw = [bytes(BACK[c] for c in a.id_to_token(i)) for i in a_ids]
    b_raw = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if not b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
        return none
    places = []
    for raw in (a_raw, b_raw):
        ends = np.cumsum(list(map(len, raw)))
        places.append([(int(e) - len(r), int(e)) for e, r in zip(ends, raw)])
    links = [(x, y) for x, (s, e) in zip(a_ids, places[0]) for y, (t, f) in zip(b_ids, places[1]) if s < f and t < e]
    groups, edges = [], sorted({e for _, e in places[0]} & {e for _, e in places[1]})
    for lo, hi in zip([0, *edges], edges):
        groups.append(tuple([i for i, (s, e) in zip(ids, p) if lo <= s and e <= hi] for ids, p in zip((a_ids, b_ids), places)))
    return a_ids, b_ids, links, groups


def texts() -> list:
    rnd = random.Random(4)
    pieces = ["the ", "Hello", " ", "  ", "   ", "\n", " \n", "\n ", "\t", "é", "naïve ", "中文", "😀", "x1y2", "http://a.b/c?d=e ", "don't ", "12345 ", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x0A>", "­", "\x00", " ", "aGVsbG8=", "'", " 's", "Ġ", "�", "é"]
    out = [None, "", " ", "\n", "▁", "a ▁b", "word", " word", "word ", "plain words of prose, with marks. " * 40, "unbroken" * 400]
    return out + ["".join(rnd.choices(pieces, k=rnd.randrange(1, 60))) for _ in range(150)] + [" ".join(rnd.choices(["alpha", "beta", "naïve", "x,y"], k=rnd.randrange(1, 400))) for _ in range(20)]


def test_sequences_are_those_of_the_libraries(libraries):
    pair = alignment.Pair(A, B)
    assert pair.cuts
    given = texts()
    for window in (1, 7, 1000, 1000):  # the last time from the memo
        if window < 1000:
            pair.memo.clear()
        cut = [given[k : k + window] for k in range(0, len(given), window)]
        for text, found in zip(given, [x for part in cut for x in pair.documents([t or "" for t in part])]):
            a_ids, b_ids, _, _ = brute(text, libraries)
            for k, ids in enumerate((a_ids, b_ids)):
                assert np.frombuffer(b"".join(s[k] for s in found), np.uint32).tolist() == ids, text


def test_real_texts_are_those_of_the_libraries(spark, libraries):
    pair = alignment.Pair(A, B)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        a_ids, b_ids = (libraries[0].encode(" " + r.text, add_special_tokens=False).ids, libraries[1].encode(r.text)) if r.text else ([], [])
        found = pair.documents([r.text or ""])[0]
        assert not found or [np.frombuffer(b"".join(s[k] for s in found), np.uint32).tolist() for k in (0, 1)] == [a_ids, b_ids]


def test_rows_are_those_of_loops(spark, libraries, monkeypatch):
    """Whole result, with the pairs broadcast and shuffled; repeated and null ids; columns with clashing names."""
    rows = [(k % 90 if k % 17 else None, t, "x", 1) for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, links string, row int").repartition(3)
    judged = [(i, *brute(t, libraries)) for i, t, *_ in rows]
    counts = Counter(p for *_, links, _ in judged for p in set(links))
    highest: dict = {}
    for (a, _), n in counts.items():
        highest[a] = max(n, highest.get(a, 0))
    expected = []
    for i, a_ids, b_ids, links, groups in judged:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(said.encode()).hexdigest() if a_ids else ""
        expected.append((i, len(a_ids), len(b_ids), len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links), digest))
    key = lambda r: (r[0] is None, *map(str, r))
    monkeypatch.setattr(alignment, "CHUNKS", 5)
    path = alignment.scratch(spark, "test")
    alignment.aligned(docs, A, B, spans=True).write.parquet(path)
    held = spark.read.parquet(path)
    for pairs in (0, 10**6):
        found = alignment.scored(held, 32_000, pairs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
        assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    spans = sorted((tuple(r.a_ids), tuple(r.b_ids), len(r.cuts), r.cuts[-1] if r.cuts else 0) for r in held.collect())
    sizes = {t: len((" " + t).encode()) for _, t, *_ in rows if t}
    assert spans == sorted((tuple(a), tuple(b), len(g), sizes[t] if a else 0) for (_, t, *_), (_, a, b, _, g) in zip(rows, judged))
    assert alignment.scored(held.limit(0), 32_000).count() == 0


def test_op11_on_the_small_tables(spark, libraries):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = alignment.op11_lockstep_alignment(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(docs)
    for r in found:
        text = docs[r.doc_id]
        if text is None or len(text) > 1500:
            continue
        a_ids, b_ids, links, groups = brute(text, libraries)
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a_ids), len(b_ids), len(groups), len(links))
