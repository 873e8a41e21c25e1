"""License scans with a positional rare-token index.

Licence templates are indexed by the places of the rarest words of their mandatory key phrases
(highest IDF, counted over all documents). Each file looks up its own licence words, highest IDF first;
the postings found are intersected by relative position, and a place where all agree is verified: the
key phrases must stand at their places, and enough of the template's words. Key phrases can't be
altered, so no occurrence is lost. A file's cost depends on the templates whose rarest word it has, not on
how many templates there are.

Cases: a null text is empty and has no words, labels "" and score 0. Repeated
rows give repeated results. An empty table gives an empty result. Nothing but the
id and the text is read, so other columns never clash.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Words are runs of ASCII letters and digits and of any other character above ASCII, lower-cased A-Z.
SPACES = bytes(32 if not (chr(b).isalnum() or b >= 128) else b + 32 if 65 <= b <= 90 else b for b in range(256))

# Phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Licence templates; square brackets mark the mandatory key phrases.
TEMPLATES = {
    "mit-notice": "[released under the mit license]",
    "mit-grant": "[permission is hereby granted free of charge to any person] obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software [without restriction]",
    "apache-2.0-notice": "[licensed under the apache license version 2 0]",
    "gpl-3-notice": "this work is [licensed under the gnu general public license version 3]",
    "gpl-grant": "this program is [free software you can redistribute it and or modify it] under the terms of the gnu "
                 "[general public license] as published by the free software foundation",
    "cc-by-nc-4.0": "[licensed under cc by nc 4 0]",
    "cc-by-4.0": "[licensed under cc by 4 0]",
    "cc-by-sa-4.0": "[licensed under cc by sa 4 0]",
    "bsd-conditions": "[redistribution and use in source and binary forms] with or without modification are "
                      "[permitted provided that the following conditions are met]",
    "isc-grant": "[permission to use copy modify and or distribute this software] for any purpose with or without fee "
                 "[is hereby granted]",
    "mpl-2.0-notice": "this source code form is [subject to the terms of the mozilla public license v 2 0]",
    "all-rights-reserved": "[all rights reserved]",
    "mit-text": "[permission is hereby granted free of charge to any person] obtaining a copy of this software and associated "
                "documentation files the software to deal in the software [without restriction] including without limitation the "
                "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
                "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
                "and this permission notice shall be included in all copies or substantial portions of the software [the software is "
                "provided as is without warranty of any kind] express or implied including but not limited to the warranties of "
                "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
                "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
                "arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-text": "[permission to use copy modify and or distribute this software] for any purpose with or without fee [is hereby "
                "granted] provided that the above copyright notice and this permission notice appear in all copies [the software is "
                "provided as is and the author disclaims all warranties] with regard to this software including all implied "
                "warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or "
                "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of "
                "contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "apache-2.0-header": "[licensed under the apache license version 2 0] the license you may not use this file except in compliance "
                         "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless "
                         "required by applicable law or agreed to in writing software distributed under the license is distributed on "
                         "an as is basis [without warranties or conditions of any kind] either express or implied see the license for "
                         "the specific language governing permissions and limitations under the license",
}
#: Rare places in a template's key phrases that are indexed, and the share of its words that must be in place.
ANCHORS, COVERAGE = 4, 0.8


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(SPACES).split()


def parse(template: str) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Words of a template, and the (start, end) places of its key phrases."""
    words: list[bytes] = []
    keys = []
    for i, part in enumerate(re.split(r"[\[\]]", template)):
        own = words_of(part)
        if i % 2:
            keys.append((len(words), len(words) + len(own)))
        words += own
    return words, keys


def vocabulary(templates: dict[str, str]) -> set[bytes]:
    return {w for t in templates.values() for w in parse(t)[0]}


def document_frequency(docs: DataFrame, text_col: str, words: set[bytes]) -> tuple[dict[bytes, int], int]:
    """Documents with each word, over all documents; at most one row per template word reaches the driver."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: dict[bytes, int] = defaultdict(int)
        n = 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0).to_pylist():
                for w in words.intersection(words_of(text)):
                    seen[w] += 1
        keys = [b"", *seen]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([n, *seen.values()], pa.int64())], ["word", "n"])

    rows = (docs.select(text_or_empty(text_col).alias("t")).mapInArrow(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    found = {bytes(r["word"]): r["n"] for r in rows}
    return found, found.get(b"", 0)


class Index:
    """Positional postings of the rarest words of the templates' key phrases.

    A template is held by its ANCHORS rarest places in key phrases; key phrases can't be altered, so each occurrence
    has all of them. A file looks up its own words, highest IDF first: the rarest anchor of a template opens it with
    the starts it could have, the others narrow these. A template that shares no anchor with the file costs nothing.
    """

    def __init__(self, templates: dict[str, str], found: dict[bytes, int], n: int):
        self.templates = {k: parse(t) for k, t in templates.items()}
        idf = {w: math.log((n + 1) / (found.get(w, 0) + 1)) for w in vocabulary(templates)}
        self.rank = {w: i for i, w in enumerate(sorted(idf, key=lambda w: (-idf[w], w)))}
        self.anchors = {}
        self.postings: dict[bytes, list[tuple[str, int, int]]] = defaultdict(list)
        for label, (words, keys) in self.templates.items():
            places = sorted((q for a, b in keys for q in range(a, b)), key=lambda q: (self.rank[words[q]], q))[:ANCHORS]
            self.anchors[label] = len(places)
            for nth, q in enumerate(places):
                self.postings[words[q]].append((label, q, nth))
        self.words = set(self.postings)

    def candidates(self, at: dict[bytes, list[int]]) -> dict[str, set[int]]:
        """Label to the starts at which all its anchors stand; ``at`` has the places of the file's words."""
        starts: dict[str, set[int]] = {}
        met: dict[str, int] = defaultdict(int)
        for w in sorted((w for w in at if w in self.postings), key=self.rank.__getitem__):
            for label, q, nth in self.postings[w]:
                if nth == 0:
                    starts[label] = {p - q for p in at[w]}
                elif label in starts:
                    starts[label].intersection_update([p - q for p in at[w]])
                met[label] += 1
        return {label: s for label, s in starts.items() if s and met[label] == self.anchors[label]}

    def match(self, words: list[bytes], at: dict[bytes, list[int]]) -> dict[str, tuple[float, list[int]]]:
        """Label to (best share of words in place, starts), verified on the words."""
        out = {}
        for label, places in self.candidates(at).items():
            template, keys = self.templates[label]
            starts, best = [], 0.0
            for start in places:
                if any(start + a < 0 or words[start + a:start + b] != template[a:b] for a, b in keys):
                    continue
                same = sum(0 <= start + q < len(words) and words[start + q] == w for q, w in enumerate(template)) / len(template)
                if same >= COVERAGE:
                    starts.append(start)
                    best = max(best, same)
            if starts:
                out[label] = (best, sorted(starts))
        return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches (label, start, coverage)."""
    found, n = document_frequency(docs, text_col, vocabulary(templates))
    index = Index(templates, found, n)
    base = [(words_of(p), label) for p, label in phrases.items()]
    schema = ("doc_id {}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
              "score double, matches array<struct<label:string,start:long,coverage:double>>")
    wanted = index.words | {phrase[0] for phrase, _ in base}
    schema = schema.format(dict(docs.dtypes)[id_col])

    def scan_one(text: str) -> tuple:
        words = words_of(text)
        at: dict[bytes, list[int]] = defaultdict(list)
        if not wanted.isdisjoint(words):
            for p, w in enumerate(words):
                if w in wanted:
                    at[w].append(p)
        starts, labels = [], set()
        for phrase, label in base:
            here = [p for p in at.get(phrase[0], ()) if words[p:p + len(phrase)] == phrase]
            starts += here
            if here:
                labels.add(label)
        more = index.match(words, at) if at else {}
        score = max([0.5 * bool(labels), *(c for c, _ in more.values())])
        return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
                ",".join(sorted(labels | set(more))), float(score),
                [{"label": k, "start": s, "coverage": c} for k, (c, places) in sorted(more.items()) for s in places])

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
            [("label", pa.string()), ("start", pa.int64()), ("coverage", pa.float64())]))]
        for batch in batches:
            rows = [scan_one(t) for t in batch.column(1).to_pylist()]
            cols = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names)

    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t")).mapInArrow(scan, schema)
