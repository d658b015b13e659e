"""The filter audit against loops over texts and orders."""

import itertools
import random
import re

import numpy as np
import pytest

from wildgrid.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measures(text: str) -> list[int]:
    words = WORD.findall(text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def texts() -> list[str]:
    rnd = random.Random(5)
    pieces = ["the", "The", "é", "中文", "a#b", "|", " ", "  ", "\n", "\t\x0b\x0c\r", "\x1c", " ", " ", "x" * 70, "x" * 69 + "y", "😀", "\x00", "ZZ"]
    out = ["", " ", "a", " a", "a ", "same same", "x" * 5000, ("long word " * 3000).strip()]
    return out + ["".join(rnd.choice(pieces) + rnd.choice(["", " "]) for _ in range(rnd.randrange(1, 300))) for _ in range(120)]


@pytest.mark.parametrize("window", [1, 7, 100, 1 << 21])
def test_measures_are_those_of_loops_whatever_the_window(window):
    given = texts() if window > 1 else texts()[:40]
    raw = [t.encode() for t in given]
    found = audit.measures(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw]), window)
    assert found.tolist() == [brute_measures(t) for t in given]


def test_equal_hashes_are_verified(monkeypatch):
    """With one hash for all words the table still tells them apart."""
    monkeypatch.setattr(audit.SpanTable, "_hashes", lambda self, doc, start, size: np.zeros(len(doc), np.uint64))
    text = "ab ba ab abc " + "q" * 80 + " " + "q" * 79 + "r ab"
    found = audit.measures(np.frombuffer((text * 2).encode(), np.uint8), np.array([len(text), 2 * len(text)]))
    assert found[:, :2].tolist() == [[7, 5], [7, 5]]


def test_audit_is_that_of_loops(spark):
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(90)]
    bodies = [None, "", "  ", *(" ".join(rnd.choices(words, k=rnd.choice([3, 60, 70])) + rnd.choice([[], ["#"], ["ABCDEFGHIJKLMNOPQRSTUVWXYZ"]])) for _ in range(40)), " ".join(words)]
    rows = [(rnd.choice([None, *range(60)]), rnd.choice(bodies), rnd.choice([None, "", "a", "b"]), 1.0) for _ in range(150)] + [(7, "same", "a", 1.0), (7, "same", "a", 1.0), (99, "big " * 50_000, "b", 1.0)]
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1, None]), "x") for k in [*range(0, 60, 2), 4, 4, None]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, part double").repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, digest string")
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.audit(docs, marks).collect()}

    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    judged = []
    for i, t, s, _ in rows:
        n, distinct, capitals, points, symbols = brute_measures(t or "")
        bad = {c for c, x in zip("ABCD", (n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * points, symbols)) if x} | ({"E"} if i is not None and i > least[t or ""] else set())
        judged.append((s or "", bad, any(x == i and q == 1 for x, q, *_ in labels if x is not None), any(x == i and q == 1 for x, _, q, _ in labels if x is not None)))
    expected, total = {}, {}
    for part in {j[0] for j in judged}:
        for order in map("".join, itertools.permutations("ABCDE")):
            rest = [j[1:] for j in judged if j[0] == part]
            everyone = rest
            for k, c in enumerate(order):
                gone = [x for x in rest if c in x[0]]
                rest = [x for x in rest if c not in x[0]]
                early = sum(c in x[0] for x in everyone) - len(gone)
                expected[part, order, k + 1] = [len(rest), len(gone), early, sum(x[0] == {c} for x in everyone), sum(x[1] for x in gone), sum(x[2] for x in gone)]
                total[part, c] = total.get((part, c), 0) + len(gone)
    assert found == {(p, o, k): (*v, total[p, o[k - 1]]) for (p, o, k), v in expected.items()}
    assert audit.audit(docs.limit(0), marks).count() == 0
    assert audit.audit(docs, marks.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_notices_in_a_very_long_text(spark):
    """Half a million words with notices at known places: the blocks that hold them, in time proportional to the words."""
    from wildgrid.llm import licenses

    rnd = random.Random(3)
    template = licenses.TEMPLATES[0]
    label, notice = template[0], template[1]
    filler = ["granted", "software", "copy", "the", "of", "person", "other", "word"]
    words = rnd.choices(filler, k=500_000)
    size = licenses.window_of(template)
    for at in (0, 123_456, 499_000):
        words[at : at + len(notice.split())] = notice.split()
    df = spark.createDataFrame([(1, " ".join(words)), (2, None)], "doc_id long, text string")
    blocks = {r.block for r in licenses.similar_blocks(df, ["doc_id"], [template]).where(f"label = '{label}'").collect()}
    for at in (0, 123_456, 499_000):
        assert at - at % (size // 2) in blocks
