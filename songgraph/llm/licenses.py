"""License notices in documents, by diagonal voting.

Rolling hashes of every ``GRAM`` consecutive words of all texts are joined with those of a
set of templates. A match of text place i with template place p votes for the diagonal
i - p. Votes are added up by text, template and diagonal; diagonals within the template's
drift of the next one are merged, so that a few inserted or lost words do not split a
notice. A merged run with enough votes is a candidate, and is verified on the words
themselves: the share of the template's words that stand on one of its diagonals.

Candidates belong to a text, whatever rows hold it, so copies add to the same few
aggregates. Texts move only where one of their hashes may be a candidate's.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songgraph.llm.common import id_filter, map_rows, materialize, may_hold, ship_package
from songgraph.session import scratch

GRAM = 4                    # words of a rolling hash
SHARE = 0.25                # of a template's hashes that must vote for a merged run
SIMILAR = 0.7               # of a template's words that must stand in a verified span
# The base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Wordings of well-known licence notices, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
            "the following conditions: The above copyright notice and this permission notice shall be included in "
            "all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the "
               "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
               "to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT "
               "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
            "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")      # of lower-cased UTF-8: all but ASCII marks and white space
_MUL = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, in UTF-8."""
    return _WORD.findall((text or "").encode().lower())


class _Hashes(dict):
    """64-bit hashes of words, the commoner ones kept."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < 400_000:
            self[word] = h
        return h


_HASH = _Hashes()


def grams(ws: list[bytes], size: int) -> np.ndarray:
    """The rolling hash at every place where ``size`` words are left."""
    if len(ws) < size:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(_HASH.__getitem__, ws), np.uint64, len(ws))
    many = len(ws) - size + 1
    out = np.zeros(many, np.uint64)
    for k in range(size):
        out = out * _MUL + h[k:k + many]
    return out.view(np.int64)


def drift(length: int) -> int:
    """How far apart neighbouring diagonals of a template of so many words may be."""
    return max(1, length // 20)


def text_grams(docs: DataFrame, text: str, size: int) -> DataFrame:
    """(th, place, gram): all rolling hashes of all texts, by the texts' 64-bit hashes."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [grams(words(t), size) for t in part.column(1).to_pylist()]
                many = [len(x) for x in found]
                if sum(many):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(part.column(0).to_numpy(), many)),
                         pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in many])),
                         pa.array(np.concatenate(found))], names=["th", "place", "gram"])

    own = docs.where(F.length(f"`{text}`") > 0).select(F.xxhash64(f"`{text}`").alias("th"), F.col(f"`{text}`").alias("t"))
    return own.mapInArrow(run, "th long, place int, gram long")


def candidates(docs: DataFrame, templates, text: str, size: int, share: float) -> DataFrame:
    """(th, template, low, high): runs of merged diagonals with enough votes."""
    spark = docs.sparkSession
    index = []
    for n, (_, t) in enumerate(templates):
        ws = words(t)
        least = -(-share * max(1, len(ws) - size + 1) // 1)
        index += [(int(h), n, p, drift(len(ws)), int(least)) for p, h in enumerate(grams(ws, size))]
    # as long as the templates, whatever the corpus
    places = F.broadcast(spark.createDataFrame(index, "gram long, template int, p int, drift int, least int"))
    votes = (text_grams(docs, text, size).join(places, "gram")
             .groupBy("th", "template", (F.col("place") - F.col("p")).alias("diagonal"), "drift", "least")
             .agg(F.size(F.collect_set("p")).alias("votes")))       # a template's places at most
    order = Window.partitionBy("th", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order) > F.col("drift")
    runs = votes.withColumn("new", F.when(gap, 1).otherwise(0)).withColumn("run", F.sum("new").over(order))
    return (runs.groupBy("th", "template", "run", "least")
            .agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
            .where("votes >= least").select("th", "template", "low", "high"))


def base_places(ws: list[bytes], phrases) -> list[tuple[int, str]]:
    """(start, label) of every place of a phrase."""
    found = []
    for phrase, label in phrases:
        want = words(phrase)
        at = -1
        while True:
            try:
                at = ws.index(want[0], at + 1)
            except ValueError:
                break
            if ws[at:at + len(want)] == want:
                found.append((at, label))
    return found


def likeness(ws: list[bytes], template: list[bytes], low: int, high: int) -> float:
    """The template's words that stand on one of the diagonals from ``low`` to ``high``,
    as a share of the words that the template and the merged diagonals span."""
    where: dict[bytes, list[int]] = {}
    for i in range(max(0, low), min(len(ws), high + len(template))):
        where.setdefault(ws[i], []).append(i)
    hits = 0
    for p, w in enumerate(template):
        places = where.get(w, ())
        k = bisect_left(places, p + low)
        hits += k < len(places) and places[k] <= p + high
    return hits / (len(template) + high - low)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES,
         size: int = GRAM, share: float = SHARE, similar: float = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: the key, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans.

    ``n_base`` counts the places of ``phrases``, ``first_word`` and ``last_word`` are their
    least and greatest start (null without one). ``spans`` are the verified template spans
    as label:start:end (words, end exclusive) by start, then label. Labels are distinct,
    sorted and comma-joined; ``labels`` has the base ones and those of spans. ``score`` is
    1 with a base place, else the greatest likeness of a span, else 0.
    Null and empty texts have no words. Equal rows fare alike, a null key stays null, an
    empty table gives no rows, other columns are ignored. The result is a written table."""
    kind = docs.schema[key].dataType.simpleString()
    known = [(label, words(t)) for label, t in templates]
    out = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, " \
          "score double, spans string"

    def judge(texts, runs):
        cols = {c.split()[0]: [] for c in out.split(", ")}
        for t, found in zip(texts, runs):
            ws = words(t)
            base = base_places(ws, phrases)
            spans, score = set(), 1.0 if base else 0.0
            for n, low, high in found or ():
                label, want = known[n]
                got = likeness(ws, want, low, high)
                if got >= similar - 1e-12:
                    spans.add((max(0, low), label, min(len(ws), high + len(want))))
                    score = max(score, got)
            starts, labels = [s for s, _ in base], {x for _, x in base}
            row = (len(ws), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)),
                   ",".join(sorted(labels | {x for _, x, _ in spans})), score,
                   ",".join(f"{label}:{a}:{b}" for a, label, b in sorted(spans)))
            for c, v in zip(cols, row):
                cols[c].append(v)
        return cols

    with scratch(docs.sparkSession) as own:
        runs = materialize(candidates(docs, templates, text, size, share), "license-runs")
        bits = id_filter(runs.select("th").distinct(), "th")

        def first(cols):
            marked = may_hold(bits, cols["th"])
            return {"key": cols["key"], "th": cols["th"], "again": [t if m else None for t, m in zip(cols["t"], marked)],
                    **judge(cols["t"], [()] * len(marked))}

        rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(f"`{text}`").alias("th"), F.col(f"`{text}`").alias("t"))
        rows = materialize(map_rows(rows, first, f"key {kind}, th long, again string, {out}"), "license-rows")
        each = runs.groupBy("th").agg(F.sort_array(F.collect_list(F.struct("template", "low", "high"))).alias("runs"))

        def second(cols):
            found = [[(x["template"], x["low"], x["high"]) for x in r] for r in cols["runs"]]
            return {"key": cols["key"], **judge(cols["again"], found)}

        plain = rows.where("again is null").select("key", *[c.split()[0] for c in out.split(", ")])
        marked = rows.where("again is not null").select("key", "th", "again").join(each, "th", "left") \
            .withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<template:int,low:int,high:int>>")))
        checked = map_rows(marked.select("key", "again", "runs"), second, f"key {kind}, {out}")
        return own.keep(plain.unionByName(checked).withColumnRenamed("key", key), "licenses")
