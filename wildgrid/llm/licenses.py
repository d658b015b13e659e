"""License scans: an exact set-similarity join of text blocks with license templates.

Each text is cut into blocks: windows of words, half overlapping, so any run of up to
half a window lies wholly in one. A template's window is ``WINDOW``, doubled until half
of it holds the whole template; templates of one window share their blocks. A block
matches a template if it holds at least ``threshold`` of the template's distinct words,
and all words that the template names as compulsory. The join finds all:

* frequency: template words are ordered by the number of documents that hold them,
  counted over all documents, rarest first;
* prefix: a template of n words of which k are needed shares one of its n - k + 1
  rarest words with every match, so only blocks with such a word are candidates;
* length: a block with fewer than k words of the vocabulary is none;
* position: what follows the shared word in both orders must suffice for k;
* then the overlap is counted exactly.

DataFrame functions only. What the driver holds is bounded by the templates, a list
that the caller gives (``MAX_WORDS`` words at most, more are an error).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, UPPER, lower_ascii, table

_LOWER = str.maketrans(UPPER, LOWER)
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
]
#: Real notices and texts, with the words that none of their copies lacks.
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
NOTICES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS, "sublicense"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "fee"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "redistributions"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", "apache"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.", "gnu 3"),
]
THRESHOLD = 0.8
#: Words of a block at least.
WINDOW = 64
MAX_WORDS = 20_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and all characters beyond ASCII; null has none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def _count(part: Column) -> Column:
    """Words of a part of ' w w w '."""
    return (F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit(""))) - 1).cast("long")


def phrase_places(joined: Column, n: Column, phrase: str) -> Column:
    """(n, first, last) of the places where ``phrase`` stands in ' w w w ', overlapping ones too."""
    found = F.split(joined, rf"(?<= )(?={re.escape(phrase)} )", -1)
    # the last part begins with the phrase and has no space before it
    last = n - _count(F.concat(F.lit(" "), F.element_at(found, -1)))
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), F.struct((F.size(found) - 1).cast("long").alias("n"), _count(F.element_at(found, 1)).alias("first"), last.alias("last")))


def scan_phrases(docs: DataFrame, phrases=PHRASES, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word and base, the array of labels found."""
    w = docs.withColumn("lic_words", words(F.col(f"`{text}`")))
    w = w.withColumn("n_words", F.size("lic_words").cast("long")).withColumn("lic_joined", F.concat(F.lit(" "), F.array_join("lic_words", " "), F.lit(" ")))
    each = [F.struct(F.lit(label).alias("label"), phrase_places(F.col("lic_joined"), F.col("n_words"), phrase).alias("at")) for phrase, label in phrases]
    w = w.withColumn("lic_found", F.filter(F.array(*each), lambda x: x["at"].isNotNull()))
    total = F.aggregate("lic_found", F.lit(0).cast("long"), lambda s, x: s + x["at"]["n"])
    places = {"n_base": total, "first_word": F.array_min(F.transform("lic_found", lambda x: x["at"]["first"])), "last_word": F.array_max(F.transform("lic_found", lambda x: x["at"]["last"])), "base": F.array_sort(F.array_distinct(F.transform("lic_found", lambda x: x["label"])))}
    return w.withColumns(places).drop("lic_words", "lic_joined", "lic_found")


def _template(template: tuple) -> tuple[str, list[str], list[str]]:
    """(label, text) or (label, text, compulsory words) -> label, words, compulsory words."""
    label, *texts = template
    of = lambda t: [w for w in re.split(NOT_WORD, t.translate(_LOWER)) if w]
    found, must = of(texts[0]), sorted(set(of(texts[1]))) if len(texts) > 1 else []
    if not found or set(must) - set(found):
        raise ValueError(f"template {label}: no words, or compulsory ones that it doesn't hold")
    return label, found, must


def window_of(template: tuple) -> int:
    """``WINDOW``, doubled until half of it holds the template."""
    n, window = len(_template(template)[1]), WINDOW
    while window < 2 * n:
        window *= 2
    return window


def template_index(docs: DataFrame, templates, threshold: float, text: str = "text") -> tuple[list[str], list[tuple]]:
    """All template words, rarest first, and a row (token, template, label, place, size, need, tokens, must) for each word of a prefix."""
    sets = [(label, sorted(set(found)), must) for label, found, must in map(_template, templates)]
    vocabulary = sorted({w for _, s, _ in sets for w in s})
    if len(vocabulary) > MAX_WORDS:
        raise ValueError(f"{len(vocabulary)} template words; at most {MAX_WORDS} are allowed")
    held = F.array_intersect(words(F.col(f"`{text}`")), F.array(*map(F.lit, vocabulary)))
    counted = dict(docs.select(F.explode(held).alias("w")).groupBy("w").count().collect())  # at most the vocabulary
    order = {w: (counted.get(w, 0), w) for w in vocabulary}
    rows = []
    for number, (label, s, must) in enumerate(sets):
        s = sorted(s, key=order.get)
        need = max(1, math.ceil(threshold * len(s) - 1e-9))
        rows += [(w, number, label, k, len(s), need, s, must) for k, w in enumerate(s[: len(s) - need + 1])]
    return sorted(vocabulary, key=order.get), rows


def similar_blocks(docs: DataFrame, key: list[str], templates=TEMPLATES, threshold: float = THRESHOLD, text: str = "text", window: int | None = None) -> DataFrame:
    """(key, window, block, label, containment) of every block that matches a template; block is its first word's number.

    Each template has the blocks of its own window unless ``window`` is given; one that some template can't fit in is an error.
    All windows' blocks are cut in one pass over the texts.
    """
    order, rows = template_index(docs, templates, threshold, text)
    windows = [window or window_of(t) for t in templates]
    rows = [(*r, windows[r[1]]) for r in rows]
    if narrow := [r for r in rows if r[5] > r[8]]:
        raise ValueError(f"a template needs {narrow[0][5]} words; a block of {narrow[0][8]} can't hold them")
    index = docs.sparkSession.createDataFrame(rows, "token string, template int, label string, place int, size int, need int, tokens array<string>, must array<string>, window int")
    prefix = F.array(*map(F.lit, sorted({r[0] for r in rows})))
    w = docs.select(*key, words(F.col(f"`{text}`")).alias("lic_words")).where(F.arrays_overlap("lic_words", prefix))
    ordered = F.array(*map(F.lit, order))

    def cut(w: Column, size: int) -> Column:
        """A window's blocks of one text, each with its template words, rarest first; the text's words themselves stay where they are."""
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(w) - 1), F.lit(size // 2))
        return F.transform(starts, lambda s: F.struct(F.lit(size).alias("window"), s.alias("block"), F.array_intersect(ordered, F.slice(w, s + 1, F.lit(size))).alias("own")))

    # the words are bound once, whatever the optimizer does with their column
    all_ = F.flatten(F.transform(F.array("lic_words"), lambda w: F.concat(*[cut(w, size) for size in sorted(set(windows))])))
    kept = F.filter(all_, lambda x: F.arrays_overlap(x["own"], prefix))
    blocks = w.select(*key, F.explode(kept).alias("at")).select(*key, "at.window", "at.block", "at.own")
    probes = blocks.select(*key, "window", "block", "own", F.explode(F.array_intersect("own", prefix)).alias("token"))
    after = F.size("own") - F.array_position("own", F.col("token"))
    near = (F.size("own") >= F.col("need")) & (1 + F.least(F.col("size") - 1 - F.col("place"), after) + F.least(F.col("place"), F.array_position("own", F.col("token")) - 1) >= F.col("need"))
    overlap = F.size(F.array_intersect("tokens", "own"))
    named = F.size(F.array_except("must", "own")) == 0
    found = probes.join(F.broadcast(index), ["token", "window"]).where(near).where((overlap >= F.col("need")) & named)  # at most MAX_WORDS words
    return found.select(*key, "window", "block", "label", (overlap / F.col("size")).alias("containment")).distinct()


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels (arrays) and score.

    score: 1 with a phrase, else the largest containment of a matching block, else 0.
    Null and empty texts have no words and no labels. Repeated rows have equal results.
    Columns named like those that are added are refused.
    """
    added = {"n_words", "n_base", "first_word", "last_word", "base", "base_labels", "labels", "score"}
    if clash := [c for c in docs.columns if c.lower() in added or c.lower().startswith("lic_")]:
        raise ValueError(f"columns {clash} clash with those that are added")
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    other = F.hash(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.withColumn("lic_key", key).withColumn("lic_other", other)
    hits = similar_blocks(keyed, ["lic_key", "lic_other"], templates, threshold, text)
    hits = hits.groupBy("lic_key", "lic_other").agg(F.collect_set("label").alias("lic_labels"), F.max("containment").alias("lic_score"))  # at most one for each template
    out = scan_phrases(keyed, phrases, text).join(hits, ["lic_key", "lic_other"], "left")
    labels = F.array_sort(F.array_union("base", F.coalesce("lic_labels", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("lic_score", F.lit(0.0)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "n_words", "n_base", "first_word", "last_word", F.col("base").alias("base_labels"), labels.alias("labels"), score.alias("score"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases, short notices, and the opening texts of common licenses with their compulsory words."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), templates=[*TEMPLATES, *NOTICES])
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def _oracle() -> str:
    """Brute force: every phrase at every word, every template in every block."""
    places = " union all ".join(f"select doc_id, '{label}' as label, i - 1 as pos from w, generate_series(1, n) g(i) where ws[i:i + {len(p.split()) - 1}] = {p.split()}" for p, label in PHRASES)
    sets = []
    for t in [*TEMPLATES, *NOTICES]:
        label, found, must = _template(t)
        own = sorted(set(found))
        sets.append(f"('{label}', {own}, {must}::varchar[], {max(1, math.ceil(THRESHOLD * len(own) - 1e-9))}, {window_of(t)})")
    sets = ", ".join(sets)
    return f"""
with w0 as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{NOT_WORD}'), lambda x: x <> '') as ws from documents),
w as (select doc_id, ws, len(ws) as n from w0),
p as ({places}),
b as (select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word, string_agg(distinct label, ',' order by label) as base_labels from p group by doc_id),
t(label, ts, must, need, size) as (values {sets}),
k as (select doc_id, size, list_distinct(ws[i + 1:i + size]) as own from w, (select distinct size from t) z, lateral (select unnest(generate_series(0, greatest(n - 1, 0), size // 2)) as i) g where i < n),
m as (select doc_id, label, max(len(list_intersect(ts, own))::double / len(ts)) as c from k join t using (size) where len(list_intersect(ts, own)) >= need and list_has_all(own, must) group by doc_id, label),
l as (select doc_id, string_agg(distinct label, ',' order by label) as labels from (select doc_id, label from p union all select doc_id, label from m) q group by doc_id),
s as (select doc_id, max(c) as c from m group by doc_id)
select w.doc_id, n::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, case when coalesce(n_base, 0) > 0 then 1 else coalesce(c, 0) end::double as score
from w left join b using (doc_id) left join l using (doc_id) left join s using (doc_id)
"""


OP9_SQL = _oracle()
