"""op1, op3, op5: round trips and brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wildgrid.llm import bitplanes, media, pieces

BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = "Ein langes Wort, é ñ and so on.\n" * 30_000
TEXTS = [None, "", " ", "a", "Zwei  Wörter\n", "tabs\tand\x0bmore \x85 　 x", "日本 語 🎈", "▁ mark ▁▁x", "don't stop 12.5%!", "dup", "dup", LONG]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, tie string")


# --- media ----------------------------------------------------------------------


def test_wav_keeps_every_byte(spark):
    rows = docs(spark).select("doc_id", media.text_payload(F.col("text")).alias("payload"))
    found = {r.doc_id: r for r in media.wav_features(media.encode_wav(rows, "payload")).collect()}
    for i, t in enumerate(TEXTS):
        b = (t or "").encode()
        b += b" " * (-len(b) % 192 or (0 if b else 192))
        assert (found[i].payload_bytes, found[i].payload_sha256, found[i].tail_crc32) == (len(b), hashlib.sha256(b).hexdigest(), zlib.crc32(b[-16:]))
        assert found[i].media_bytes == len(b) + 44
    assert found[9].fingerprint == found[10].fingerprint


def test_null_and_empty_payloads_and_clashes(spark):
    rows = spark.createDataFrame([(1, None), (2, b""), (3, b"abc")], "id int, payload binary")
    found = {r.id: r for r in media.wav_features(media.encode_wav(rows, "payload")).collect()}
    assert found[1].media_bytes is None and found[1].fingerprint is None
    assert found[2].payload_bytes == 0 and found[2].fingerprint == []
    assert media.wav_features(media.encode_wav(rows.limit(0), "payload")).count() == 0
    with pytest.raises(ValueError):
        media.encode_wav(rows.withColumn("media", F.lit(1)), "payload")
    with pytest.raises(ValueError):
        media.wav_features(rows.withColumn("fingerprint", F.lit(1)), "payload")


def test_pairs_find_known_tones():
    t = np.arange(8000)
    loud = np.where((t // 800) % 2 == 0, 100, 30)
    tone = (128 + loud * np.sin(2 * np.pi * 1000 * t / 8000)).astype(np.uint8)
    time, bins = media.peaks(tone)
    assert len(time) and (abs(bins - 1000 * media.FRAME / 8000) <= 1).all()  # the tone's own bin
    rows = media.pairs(time, bins)
    brute = [(time[i], bins[i], bins[j], time[j] - time[i]) for i in range(len(time)) for j in range(i + 1, min(len(time), i + 1 + media.FAN_OUT)) if time[j] - time[i] <= media.REACH]
    assert [tuple(r) for r in rows] == sorted(brute, key=lambda r: (r[0], r[3]))


def test_peaks_match_a_direct_transform():
    """Every bin of every frame by the sum that defines it, then the definition of a peak, on short signals."""
    n, hop = media.FRAME, media.HOP
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / (n - 1))
    wave_ = np.exp(-2j * np.pi * np.outer(np.arange(n // 2 + 1), np.arange(n)) / n)
    for seed in range(4):
        x = np.frombuffer(random.Random(seed).randbytes(n + hop * 30), np.uint8)
        frames = [(x[k : k + n].astype(float) - 128) * window for k in range(0, len(x) - n + 1, hop)]
        level = [np.floor(np.log2(np.abs(wave_ @ f)[media.LOW_BIN : -1] ** 2 + 1) * 64) for f in frames]
        best = [(int(p.max()), int(p.argmax()) + media.LOW_BIN) for p in level]
        want = [(t, b) for t, (v, b) in enumerate(best) if v > 0 and (t == 0 or v > best[t - 1][0]) and (t == len(best) - 1 or v >= best[t + 1][0])]
        assert [tuple(map(int, r)) for r in zip(*media.peaks(x))] == want


def test_spectrogram_in_parts_is_that_of_the_whole(monkeypatch):
    x = np.frombuffer(random.Random(1).randbytes(40_000), np.uint8)
    whole = np.concatenate([p for _, p in media.spectrogram(x)])
    monkeypatch.setattr(media, "CHUNK", 7)
    assert np.array_equal(whole, np.concatenate([p for _, p in media.spectrogram(x)]))


# --- planes -----------------------------------------------------------------------


@pytest.mark.parametrize("mode", bitplanes.MODES)
@pytest.mark.parametrize("ids", [[], [0], [1, 2, 70_000, 2**32 - 1], list(range(9000))])
def test_blocks_round_trip(mode, ids):
    assert bitplanes.decode_block(bitplanes.encode_block(np.array(ids, "<u4"), mode)).tolist() == ids


def test_cut_texts_have_the_ids_of_whole_ones():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    rnd = random.Random(1)
    texts = [x or "" for x in TEXTS[:-1]] + ["<|endoftext|> a b", "hello <|endoftext|> world", "y" * 200 + " " + "x" * 200, *("".join(rnd.choice("ab é1'.,\n \t\x1c\x85　sS²ß") for _ in range(rnd.randint(0, 40))) for _ in range(800))]
    assert bitplanes.Encoder(BYTE_BPE)(texts) == [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert bitplanes.Encoder(BYTE_BPE, memo=3)(texts[:50]) == bitplanes.Encoder(BYTE_BPE)(texts[:50])


def test_other_tokenizers_see_whole_texts(tmp_path):
    """Files with a normalizer or another pre-tokenizer: no cutting, still the library's ids."""
    import json

    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    texts = [" Ab  Cd", "x y", "A<|endoftext|> B"]
    for k, change in enumerate(({"normalizer": normalizers.Lowercase()}, {"pre_tokenizer": pre_tokenizers.ByteLevel(add_prefix_space=True)})):
        t = Tokenizer.from_file(BYTE_BPE)
        for name, value in change.items():
            setattr(t, name, value)
        path = tmp_path / f"{k}.json"
        path.write_text(json.dumps(json.loads(t.to_str())))
        enc = bitplanes.Encoder(str(path))
        assert not enc.cuts and enc(texts) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert bitplanes.Encoder(BYTE_BPE).cuts


def test_stored_ids_are_those_in_order(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    path = bitplanes.scratch(spark, "test")
    bitplanes.write_tokens(docs(spark), path, BYTE_BPE, block=1000, slice_rows=4)
    found = bitplanes.read_tokens(spark, path, with_ids=True).orderBy("doc_id").collect()
    at = 0
    for r, text in zip(found, TEXTS, strict=True):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids) // 4, zlib.crc32(ids), ids)
        at += r.n_tokens
    index = bitplanes.chunk_index(spark, path).orderBy("position").collect()
    assert sum(r.n_ids for r in index) == at and [r.position for r in index] == list(np.cumsum([0, *(r.n_ids for r in index)])[:-1])


def test_special_tokens_in_texts_are_those_of_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    texts = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>\n b  <|endoftext|><|endoftext|> c", "<|endoftext| >", "plain"]
    path = bitplanes.scratch(spark, "test")
    bitplanes.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, BYTE_BPE)
    found = bitplanes.read_tokens(spark, path, with_ids=True).orderBy("doc_id").collect()
    want = [[*t.encode(x, add_special_tokens=False).ids, 0] for x in texts]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == want and want[0] == [50256, 0]


def test_no_documents_and_repeated_ids(spark):
    path = bitplanes.scratch(spark, "test")
    bitplanes.write_tokens(docs(spark).limit(0), path, BYTE_BPE)
    assert bitplanes.read_tokens(spark, path).count() == 0
    path = bitplanes.scratch(spark, "test")
    bitplanes.write_tokens(spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (1, "c")], "doc_id long, text string"), path, BYTE_BPE)
    assert [r.doc_id for r in bitplanes.read_tokens(spark, path).orderBy("start").collect()] == [None, 1, 1, 1]


# --- pieces ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(PIECE_BPE)


def best_score(model, text):
    """Every way over the text, by all its substrings."""
    of = {model.pieces[i]: s for i, s in model.scores.items()}
    best = [0.0]
    for end in range(1, len(text) + 1):
        best.append(max([best[end - 1] + model.unknown] + [best[b] + of[text[b:end]] for b in range(max(0, end - 16), end) if text[b:end] in of]))
    return best[-1]


def test_paths_are_best(encoder):
    rnd = random.Random(7)
    for _ in range(300):
        text = "▁" + "".join(rnd.choice("theanigs▁éx🎈") for _ in range(rnd.randint(0, 25)))
        assert encoder.model.viterbi(text)[1] == best_score(encoder.model, text)
    for text in ("the quick brown fox", "Anation  of\nthings é"):
        assert encoder(text)[1] == best_score(encoder.model, "▁" + text.replace(" ", "▁"))


def test_pieces_round_trip(spark, encoder):
    found = pieces.decode(pieces.encode(docs(spark), PIECE_BPE), PIECE_BPE).orderBy("doc_id").collect()
    assert [r.decoded for r in found] == TEXTS
    assert found[0].ids is None and found[0].piece_score is None and found[1].ids == [] and found[1].piece_score == 0
    assert found[9].ids == found[10].ids
    assert pieces.encode(docs(spark).limit(0), PIECE_BPE).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(docs(spark).withColumn("ids", F.lit(1)), PIECE_BPE)


def test_small_memo_changes_nothing(encoder):
    small = pieces.Encoder(PIECE_BPE, memo=2)
    for t in ("one two three four five two one", LONG[:5000]):
        assert small(t) == encoder(t)
