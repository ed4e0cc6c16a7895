"""License scan by a positional rare-token index.

``TEMPLATES`` lists phrases of license notices with the key phrases that must
stand in them. One pass over all documents counts, for every template word, the
documents that hold it; the inverse document frequencies (IDF) choose each
template's ``ANCHORS`` rarest words, and the index maps an anchor to its postings
(template, position).

Per document, its anchor words (the licence words of highest IDF) are looked up,
each posting giving a place where the template would begin; postings are
intersected by that relative position: a place counts if ``AGREE`` different
anchors of the template (all, if it has fewer) point to it. There, every word of the
template is compared, the key phrases must stand word for word at their
positions, and the IDF share of the words found is the place's score. Labels are
given for places that score ``threshold`` or more; a document's score is its best
verified place's.

The four ``BASE`` phrases are counted at all of their places besides, by whole words.

Defined cases: null and empty texts have no words, no labels and score 0; a
template cut off by a text's edge scores its visible words only; places that
repeat count each; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_text_size, column_udf, id_text
from .text_arrays import Words, lowered, word_hash

# The phrases counted as base places, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices by label, as lower-case words, and their key phrases.
TEMPLATES: list[tuple[str, str, tuple[str, ...]]] = [
    *((label, phrase, (phrase,)) for phrase, label in BASE.items()),
    ("apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache", "you may not use this file except in compliance with the license", ("except in compliance with the license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ("hereby granted free of charge",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
     " public license", ("free software you can redistribute it", "gnu general public license")),
    ("gpl", "licensed under the gpl version 3", ("the gpl",)),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use in source and binary forms",)),
    ("bsd", "released under the bsd license", ("bsd license",)),
    ("mpl", "subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
     " granted", ("for any purpose with or without fee",)),
    ("unlicense", "free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("cc0", "dedicated to the public domain under the cc0 license", ("cc0",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
]

ANCHORS = 4
AGREE = 2
FIELDS = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double")


@dataclass(frozen=True)
class Index:
    idf: dict[str, float]
    anchors: list[list[int]]  # per template: positions of its rarest words


def vocabulary() -> list[str]:
    return sorted({w for _, phrase, _ in TEMPLATES for w in phrase.split()})


def _spread(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of words, the order, and a table of their leading 16 bits
    that rejects most other hashes."""
    hashes = np.array([word_hash(w) for w in words], np.uint64)
    order = np.argsort(hashes)
    table = np.zeros(1 << 16, bool)
    table[(hashes >> np.uint64(48)).astype(np.int64)] = True
    return hashes[order], order, table


def _occurrences(words: Words, spread) -> tuple[np.ndarray, np.ndarray]:
    """(word place, which of the listed words) of all their occurrences."""
    hashes, order, table = spread
    place = np.flatnonzero(table[(words.hash >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(hashes, words.hash[place]), len(hashes) - 1)
    same = hashes[at] == words.hash[place]
    return place[same], order[at[same]]


def _document_counts(listed: list[str]):
    def run(batches):
        spread = _spread(listed)
        total, rows = np.zeros(len(listed), np.int64), 0

        def add(batch):
            nonlocal rows
            rows += batch.num_rows
            words = Words(lowered(batch.column(1), ascii_only=True))
            place, which = _occurrences(words, spread)
            text = np.searchsorted(words.bounds, place, "right") - 1
            total.__iadd__(np.bincount(np.unique(text * len(listed) + which) % len(listed), minlength=len(listed)))

        for _ in by_text_size(batches, add):
            pass
        yield pa.RecordBatch.from_arrays([pa.array([*listed, ""]), pa.array([*total.tolist(), rows])], names=["word", "n"])

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Document frequencies over all of ``docs``; one row per template word comes back."""
    counts = dict(id_text(docs, id_col, text_col).mapInArrow(_document_counts(vocabulary()), "word string, n bigint")
                  .groupBy("word").agg(F.sum("n")).collect())
    rows = counts.get("", 0)
    idf = {w: float(np.log1p((rows + 1) / (counts.get(w, 0) + 1))) for w in vocabulary()}
    anchors = []
    for _, phrase, _ in TEMPLATES:
        split = phrase.split()
        rare = sorted(set(split), key=lambda w: (-idf[w], w))[:ANCHORS]
        anchors.append([i for i, w in enumerate(split) if w in rare])
    return Index(idf, anchors)


def _stand(words: Words, start: np.ndarray, end: np.ndarray, hashes: list[int], spelled: list[str]) -> np.ndarray:
    """Whether these words stand consecutively from ``start`` (word places),
    before ``end``; the bytes of hits are compared too."""
    ok = (start >= 0) & (start + len(hashes) <= end)
    for j, h in enumerate(hashes):
        at = np.flatnonzero(ok)
        ok[at] = words.hash[start[at] + j] == np.uint64(h)
    for i in np.flatnonzero(ok):
        ok[i] = all(words.word(int(start[i]) + j) == w.encode() for j, w in enumerate(spelled))
    return ok


def scanner(index: Index, threshold: float = 0.6):
    """Column function: text -> struct of ``FIELDS``."""
    anchor_words = sorted({phrase.split()[i] for (_, phrase, _), places in zip(TEMPLATES, index.anchors, strict=True)
                           for i in places} | {p.split()[0] for p in BASE})

    def scan(texts: pa.Array) -> pa.Array:
        words = Words(lowered(texts, ascii_only=True))
        bounds, n = words.bounds, len(texts)
        place, which = _occurrences(words, _spread(anchor_words))
        spread_of = {w: place[which == k] for k, w in enumerate(anchor_words)}
        n_base = np.zeros(n, np.int64)
        first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        base: list[set[str]] = [set() for _ in range(n)]
        labels: list[set[str]] = [set() for _ in range(n)]
        score = np.zeros(n)
        for phrase, label in BASE.items():
            spelled = phrase.split()
            start = spread_of[spelled[0]]
            text = np.searchsorted(bounds, start, "right") - 1
            ok = _stand(words, start, bounds[text + 1], [word_hash(w) for w in spelled], spelled)
            start, text = start[ok], text[ok]
            np.add.at(n_base, text, 1)
            np.minimum.at(first, text, start - bounds[text])
            np.maximum.at(last, text, start - bounds[text])
            for t in text.tolist():
                base[t].add(label)
        for (label, phrase, keys), anchors in zip(TEMPLATES, index.anchors, strict=True):
            spelled = phrase.split()
            hashes = [word_hash(w) for w in spelled]
            found = [(spread_of[spelled[i]], i) for i in anchors]
            begin = np.concatenate([p - i for p, i in found])
            text = np.concatenate([np.searchsorted(bounds, p, "right") - 1 for p, _ in found])
            name = np.concatenate([np.full(len(p), anchor_words.index(spelled[i])) for p, i in found])
            votes = np.unique(np.stack([text, begin, name]), axis=1)  # one vote a word and place
            at, count = np.unique(votes[:2], axis=1, return_counts=True)
            text, begin = at[:, count >= min(AGREE, len({spelled[i] for i in anchors}))]
            for key in keys:
                part = key.split()
                offset = next(k for k in range(len(spelled)) if spelled[k: k + len(part)] == part)
                start = begin + offset
                ok = (start >= bounds[text]) & _stand(words, start, bounds[text + 1], hashes[offset: offset + len(part)], part)
                text, begin = text[ok], begin[ok]
            if not len(text):
                continue
            idf = np.array([index.idf[w] for w in spelled])
            mass = np.zeros(len(text))
            for j, h in enumerate(hashes):
                inside = (begin + j >= bounds[text]) & (begin + j < bounds[text + 1])
                mass[inside] += idf[j] * (words.hash[begin[inside] + j] == np.uint64(h))
            share = mass / idf.sum()
            for t, s in zip(text.tolist(), share.tolist(), strict=True):
                if s >= threshold:
                    labels[t].add(label)
                    score[t] = max(score[t], min(s, 1.0))
        some = n_base > 0
        return pa.StructArray.from_arrays(
            [pa.array(words.count().astype(np.int64)), pa.array(n_base), pa.array(first, mask=~some), pa.array(last, mask=~some),
             pa.array([",".join(sorted(b)) for b in base], pa.string()),
             pa.array([",".join(sorted(a | b)) for a, b in zip(base, labels, strict=True)], pa.string()), pa.array(score)],
            names=[f.split()[0] for f in FIELDS.split(", ")])

    return column_udf(scan, f"struct<{FIELDS.replace(' ', ':').replace(',:', ',')}>")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """One row per row of ``docs``: id and ``FIELDS``."""
    index = build_index(docs, id_col, text_col)
    return docs.select(F.col(id_col), scanner(index, threshold)(F.col(text_col)).alias("found")).select(id_col, "found.*")
