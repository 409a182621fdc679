"""License scans by diagonal voting.

A template is a phrase or notice that stands for a license.  Words are runs of digits, letters a to z after A to Z are
lowered, and all characters from U+0080 on.

1. Every run of ``k`` words of every text, coded in 64 bits, is joined by Spark to the places where it stands in
   templates.  A text place minus its template place is a diagonal; equal ones belong to one occurrence.
2. Votes are counted per text, template and diagonal.  Diagonals no further apart than the template's errors are merged, as a
   word left out or put in moves the rest by one.  With ``e`` words changed, left out or put in, at least ``n - k + 1 - k e`` of a
   template's runs remain, so merged diagonals with fewer votes are given up without losing a match.
3. What is left is verified on the words themselves: the span of the text near the diagonals with the fewest
   changed, missing or added words is a match if these are at most a fifth of the template's words (none for a base phrase)
   and the template's distinctive phrases stand in it.  Of overlapping notices of different licenses the closest one stays.  Base phrases
   all stay.

Diagonals are shuffled by text and template, never by run of words: a run that is everywhere meets the
templates' places where it stands.  Those places are broadcast, as their number is known, up to ``MOST_BROADCAST``.  Texts are
cut into parts of about ``STEP_BYTES`` for coding, so that a long one takes no more memory than its words' places.

Defined cases: a null text is empty; a text without words has no finds and score 0; rows of one id and text are found
alike, each row once; ids may be null or repeat; empty tables give empty results; other columns are ignored, whatever their
names.  Runs are compared by 64-bit codes, matches by words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revmart.llm.common import stored, text_of
from revmart.llm.wordcodes import codes_of, gram_codes, spans

K = 3
STEP_BYTES = 1 << 20
#: Share of a notice's words that may be changed, left out or put in.
ERRORS = 0.2
#: Template places that are broadcast; 24 bytes each.
MOST_BROADCAST = 1 << 20
_BYTES = np.arange(256)
IS_GAP = ~(((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80))


def words_of(text: bytes) -> list[bytes]:
    """The words of a lowered text."""
    starts, ends = spans(np.frombuffer(text, np.uint8), IS_GAP)
    return [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


@dataclass(frozen=True)
class Template:
    """A phrase (``base``: it must stand there word by word) or a notice, with phrases that must stand in a match."""

    label: str
    text: str
    must: tuple[str, ...] = ()
    base: bool = False
    words: tuple[bytes, ...] = field(init=False)
    errors: int = field(init=False)

    def __post_init__(self) -> None:
        words = tuple(words_of(self.text.encode().lower()))
        if not words or "," in self.label:
            raise ValueError(f"a template needs words and a label without commas: {self.label}")
        object.__setattr__(self, "words", words)
        object.__setattr__(self, "errors", 0 if self.base else int(ERRORS * len(words)))


# Published notices by which licenses are declared, and phrases that name one.
PHRASES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
NOTICES = (
    Template("mit", "released under the MIT license", ("mit",)),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache", "version 2")),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        ("apache",),
    ),
    Template(
        "gpl-2",
        "This work is licensed under the GNU General Public License, version 2",
        ("gnu general public", "version 2"),
    ),
    Template(
        "gpl-3",
        "This work is licensed under the GNU General Public License, version 3",
        ("gnu general public", "version 3"),
    ),
    Template(
        "gpl-2",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License",
        ("gnu general public", "version 2"),
    ),
    Template(
        "gpl-3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License",
        ("gnu general public", "version 3"),
    ),
    Template(
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation",
        ("gnu lesser general public",),
    ),
    Template(
        "mpl-2",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        ("mozilla public",),
    ),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ("attribution 4",)),
    Template("cc-by", "licensed under CC BY 4.0", ("cc by 4",)),
    Template(
        "cc-by-sa",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        ("attribution sharealike 4",),
    ),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template(
        "cc-by-nc",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        ("attribution noncommercial 4",),
    ),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("public domain",)),
)


def _parts(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``STEP_BYTES`` that end between words."""
    data = np.frombuffer(text, np.uint8)
    at = 0
    while at < len(text):
        end = min(at + STEP_BYTES, len(text))
        while end < len(text):
            gap = IS_GAP[data[end : end + STEP_BYTES]]
            if gap.any():
                end += int(gap.argmax())
                break
            end += len(gap)
        yield text[at:end]
        at = end


def _codes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return codes_of(data, *spans(data, IS_GAP))


def run_codes(words: Sequence[bytes], k: int) -> np.ndarray:
    """Codes of all runs of ``k`` of some words."""
    return gram_codes(_codes(b" ".join(words)), k).view(np.int64)


def _rows(keys: list[bytes], firsts: list[int], lists: list[np.ndarray]) -> pa.RecordBatch:
    offsets = np.cumsum([0, *[len(x) for x in lists]])
    grams = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(lists).view(np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(firsts, pa.int32()), grams], ["key", "first", "grams"])


def text_grams(keyed: DataFrame, k: int) -> DataFrame:
    """``key, first, grams``: codes of all runs of ``k`` words of each text from word ``first`` on; long texts in several rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple[bytes, bytes]] = []
            size = 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lowered = text.as_py().encode().lower()
                if len(lowered) <= STEP_BYTES:
                    held.append((key, lowered))
                    size += len(lowered)
                    if size > STEP_BYTES:
                        yield from short(held)
                        held, size = [], 0
                    continue
                first, tail = 0, np.zeros(0, np.uint64)
                for part in _parts(lowered):
                    codes = np.concatenate((tail, _codes(part)))
                    grams = gram_codes(codes, k)
                    if len(grams):
                        yield _rows([key], [first], [grams])
                        first += len(grams)
                        tail = codes[len(grams) :]
                    else:
                        tail = codes
            yield from short(held)

    def short(held: list[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        data = np.frombuffer(b" ".join(t for _, t in held), np.uint8)
        starts, ends = spans(data, IS_GAP)
        begins = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for _, t in held]]))
        grams = gram_codes(codes_of(data, starts, ends), k)
        lists = [grams[a : max(a, b - k + 1)] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist())]
        used = [i for i, x in enumerate(lists) if len(x)]
        if used:
            yield _rows([held[i][0] for i in used], [0] * len(used), [lists[i] for i in used])

    return keyed.select("key", "text").mapInArrow(run, "key binary, first int, grams array<bigint>")


def template_places(spark: SparkSession, templates: Sequence[Template], k: int) -> tuple[DataFrame, int]:
    """``gram, template, place`` and the number of rows."""
    rows = []
    for number, t in enumerate(templates):
        rows += [(int(g), number, place) for place, g in enumerate(run_codes(t.words, k))]
    return spark.createDataFrame(rows, "gram bigint, template int, place int"), len(rows)


def candidates(keyed: DataFrame, templates: Sequence[Template], k: int) -> DataFrame:
    """``key, near``: for each text with enough votes, template and smallest and largest diagonal of merged diagonals."""
    spark = keyed.sparkSession
    places, n = template_places(spark, templates, k)
    needed = [(i, t.errors, max(1, len(t.words) - k + 1 - k * t.errors)) for i, t in enumerate(templates)]
    needed = spark.createDataFrame(needed, "template int, errors int, needed int")
    small = F.broadcast if n <= MOST_BROADCAST else lambda side: side
    grams = text_grams(keyed, k).select("key", "first", F.posexplode("grams").alias("i", "gram"))
    hits = grams.join(small(places), "gram").select("key", "template", (F.col("first") + F.col("i")).alias("at"), "place")
    # Repeated rows of one id and text vote once.
    diagonals = hits.distinct().groupBy("key", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.count("*").alias("votes"))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.col("errors")
    merged = (
        diagonals.join(small(needed), "template")
        .withColumn("starts", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("cluster", F.sum("starts").over(order))
        .groupBy("key", "template", "cluster")
        .agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.max("needed").alias("needed"))
        .where("votes >= needed")
    )
    return merged.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("template", "low", "high"))).alias("near"))


def _edits(template: Sequence[bytes], words: Sequence[bytes], free: bool) -> np.ndarray:
    """Fewest words changed, missing or added between the template and the words before each place; with ``free``
    words before the match are skipped."""
    known: dict[bytes, int] = {}
    t = [known.setdefault(w, len(known)) for w in template]
    x = np.array([known.get(w, -1) for w in words], np.int64)
    along = np.arange(len(x) + 1)
    row = np.zeros(len(x) + 1, np.int64) if free else along.copy()
    for i, w in enumerate(t, start=1):
        now = np.empty_like(row)
        now[0] = i
        now[1:] = np.minimum(row[1:] + 1, row[:-1] + (x != w))
        row = np.minimum.accumulate(now - along) + along
    return row


def best_match(template: Sequence[bytes], words: Sequence[bytes]) -> tuple[int, int, int]:
    """Errors of the closest span of the words, its first place and the place after its end."""
    row = _edits(template, words, free=True)
    end = int(row.argmin())
    back = _edits(template[::-1], words[:end][::-1], free=False)
    return int(row[end]), end - int(back.argmin()), end


def _stands_in(phrase: Sequence[bytes], words: Sequence[bytes]) -> bool:
    return any(tuple(words[i : i + len(phrase)]) == tuple(phrase) for i in range(len(words) - len(phrase) + 1))


Find = tuple[int, int, int, float]


def verified(templates: Sequence[Template], words: Sequence[bytes], near: Sequence[tuple[int, int, int]]) -> list[Find]:
    """(template, first word, last word, score) of the matches near merged diagonals."""
    found: set[Find] = set()
    for number, low, high in near:
        t = templates[number]
        if t.base:
            if tuple(words[low : low + len(t.words)]) == t.words:
                found.add((number, low, low + len(t.words) - 1, 1.0))
            continue
        start = max(0, low - t.errors)
        errors, a, b = best_match(t.words, words[start : high + len(t.words) + t.errors])
        span = words[start + a : start + b]
        if errors <= t.errors and all(_stands_in(words_of(m.encode().lower()), span) for m in t.must):
            found.add((number, start + a, start + b - 1, 1 - errors / len(t.words)))
    return _closest(templates, found)


def _closest(templates: Sequence[Template], found: set[Find]) -> list[Find]:
    """All base phrases, and of overlapping notices of different licenses the closest (of equals the longest)."""
    base = sorted(f for f in found if templates[f[0]].base)
    notices = sorted((f for f in found if not templates[f[0]].base), key=lambda f: (f[1], f[2], f[0]))
    rank = lambda f: (-f[3], -len(templates[f[0]].words), f[0])
    kept, group, end = [], [], -1
    for f in [*notices, None]:
        if f is None or f[1] > end:  # spans that overlap, directly or through others
            chosen: list[Find] = []
            for g in sorted(group, key=rank):
                apart = all(g[1] > h[2] or g[2] < h[1] or templates[g[0]].label == templates[h[0]].label for h in chosen)
                chosen += [g] * apart
            kept, group = kept + chosen, []
        if f is not None:
            group.append(f)
            end = max(end, f[2])
    return sorted(base + kept, key=lambda f: (f[1], f[2], f[0]))


FOUND = "array<struct<label: string, first: int, last: int, score: double, base: boolean>>"
_FOUND = pa.list_(
    pa.struct([("label", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())])
)


def scan_licenses(docs: DataFrame, phrases: Sequence[Template] = PHRASES, notices: Sequence[Template] = NOTICES) -> DataFrame:
    """Return ``doc_id, n_words, found`` for every row of ``docs`` (doc_id, text).

    ``found`` lists the matches in order of place: label, first and last word, score, and whether it is a base phrase.
    """
    templates = [*phrases, *notices]
    k = min([K, *[len(t.words) for t in templates]])
    text = text_of()
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    keyed = docs.select("doc_id", text.alias("text"), F.unhex(F.md5(named.cast("binary"))).alias("key"))
    near = stored(candidates(keyed, templates, k)).withColumnRenamed("key", "of")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, finds = [], []
            for text, near in zip(batch.column(1), batch.column(2).to_pylist()):
                lowered = text.as_py().encode().lower()
                starts, ends = _word_spans(lowered)
                counts.append(len(starts))
                found = _find(templates, lowered, starts, ends, near) if near else []
                finds.append(
                    [{"label": templates[t].label, "first": a, "last": b, "score": s, "base": templates[t].base} for t, a, b, s in found]
                )
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(finds, _FOUND)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "found"])

    joined = keyed.join(near, F.col("key") == F.col("of"), "left").select("doc_id", "text", "near")
    return joined.mapInArrow(run, f"doc_id {kind}, n_words bigint, found {FOUND}")


def _word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word, found part by part."""
    parts, at = [], 0
    for part in _parts(text):
        starts, ends = spans(np.frombuffer(part, np.uint8), IS_GAP)
        parts.append((starts + at, ends + at))
        at += len(part)
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


class _Words(Sequence):
    """The words of a text by place, cut out when asked for."""

    def __init__(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        self.text, self.starts, self.ends = text, starts, ends

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, at):  # noqa: ANN001, ANN204
        if isinstance(at, slice):
            return [self.text[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist())]
        return self.text[self.starts[at] : self.ends[at]]


def _find(templates: Sequence[Template], text: bytes, starts: np.ndarray, ends: np.ndarray, near: list[dict]) -> list[Find]:
    return verified(templates, _Words(text, starts, ends), [(c["template"], c["low"], c["high"]) for c in near])
