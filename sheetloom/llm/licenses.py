"""License notices in documents: winnowed fingerprints, then banded alignment.

Each template is cut into shingles of ``SHINGLE`` words; of every ``WINDOW`` adjacent
shingle hashes the smallest is kept, so that any common run of SHINGLE + WINDOW - 1 words
shares a fingerprint.  The templates' fingerprints are an inverted index (their number is
fixed by the template list, not by the documents); a document's fingerprints are looked up
in it, and each hit votes for the place where the template would begin.

An edited notice need not keep such a run.  The index therefore also holds, per template,
pairs of neighbouring words: one more than a notice of ``COVERAGE`` may lack words, and no
word in two of them.  Whatever words are missing, one pair is whole in the document, with at most
``BAND`` words in between, and is looked up as such.

Around each place the template's words are aligned with the document's, gaps up to
``BAND`` words.  Matched words over the template's words are the coverage; the span runs
from the first to the last matched word.

Documents are read once and nothing of them is shuffled: the look-up is part of the row,
and only rows with a place go on, with their text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHINGLE = 3
WINDOW = 2
BAND = 6
COVERAGE = 0.8
_NOT_WORD = r"[^\p{L}\p{N}]+"
_WORD = re.compile(r"[^\W_]+")

# The usual short notices of public licenses, word for word.
TEMPLATES = {
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
                "License, or (at your option) any later version."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.",
                  "Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
                     "License.", "Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License.", "Licensed under CC BY-NC 4.0."],
}


def words(text: str | None) -> list[tuple[str, int, int]]:
    """(lower-case word, first character, past the last) of each run of letters and digits."""
    return [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text or "")]


def _tokens(text: Column) -> Column:
    """As :func:`words` in Spark: split first, then lower-cased."""
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), _NOT_WORD), lambda w: w != ""), F.lower)


def _hashes(tokens: Column) -> Column:
    starts = F.when(F.size(tokens) >= SHINGLE, F.sequence(F.lit(0), F.size(tokens) - SHINGLE)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(SHINGLE)]))


def _winnowed(hashes: Column, wanted: list[int] | None = None) -> Column:
    """``at, h`` of the hashes that some window of neighbours has as its minimum; only
    those ``wanted``, where a list is given."""
    def smallest(h: Column, i: Column) -> Column:
        near = [F.coalesce(F.get(hashes, i + d), F.lit((1 << 63) - 1)) for d in range(-WINDOW + 1, WINDOW)]
        hit = F.lit(False)
        for k in range(WINDOW):
            window = near[k:k + WINDOW]
            hit = hit | (h <= (F.least(*window) if len(window) > 1 else window[0]))
        return hit if wanted is None else h.isin(wanted) & hit

    return F.filter(F.transform(hashes, lambda h, i: F.when(smallest(h, i), F.struct(
        i.alias("at"), h.alias("h")))), lambda f: f.isNotNull())


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys, at, h``: the winnowed shingle hashes of a text, with their word positions."""
    hashed = df.select(*keys, _tokens(F.col(text)).alias("w")).select(*keys, _hashes(F.col("w")).alias("hs"))
    # outer: else the optimiser repeats the whole expression in a filter on the scan
    return (hashed.select(*keys, F.explode_outer(_winnowed(F.col("hs"))).alias("f"))
            .where("f is not null").select(*keys, "f.at", "f.h"))


def template_table(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    rows = [(name, k, text) for name, texts in templates.items() for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "license_id string, variant int, notice string")


def sure_pairs(template: list[str]) -> list[tuple[int, str, str]]:
    """(place, word, next word) of the pairs of which every notice of ``COVERAGE`` keeps
    one; the longest words, which are the rarer ones, where there is a choice."""
    lacking = len(template) - math.ceil(COVERAGE * len(template) - 1e-9)
    ranked = sorted(range(len(template) - 1), key=lambda i: (-len(template[i]) - len(template[i + 1]), i))
    for start in (None, 0):         # the best pairs, else all from the first word on
        chosen: list[int] = []
        for i in ranked if start is None else range(0, len(template) - 1, 2):
            if len(chosen) <= lacking and all(abs(i - j) > 1 for j in chosen):
                chosen.append(i)
        if len(chosen) > lacking:
            break
    return [(i, template[i], template[i + 1]) for i in sorted(chosen)]


def _lookup(entries: list[tuple[object, str, int, int]], kind: str) -> tuple[list, Column]:
    """Keys, and a map from key to the (license, variant, place) that it votes for."""
    votes: dict = {}
    for key, name, variant, place in entries:
        votes.setdefault(key, []).append((name, variant, place))
    table = F.create_map(*[x for key, found in votes.items() for x in (
        F.lit(key).cast(kind), F.array(*[F.struct(F.lit(n).alias("license_id"), F.lit(v).alias("variant"),
                                                  F.lit(p).alias("place")) for n, v, p in found]))])
    return list(votes), table


def with_places(docs: DataFrame, templates: dict[str, list[str]]) -> DataFrame:
    """``doc_id, text, places`` of the rows where some template may begin."""
    spark = docs.sparkSession
    # both parts of the index are bounded by the template list
    index = fingerprints(template_table(spark, templates), ["license_id", "variant"], "notice").collect()
    hashes, by_hash = _lookup([(r["h"], r["license_id"], r["variant"], r["at"]) for r in index], "long")
    pairs = [(f"{a} {b}", name, k, i) for name, texts in templates.items() for k, text in enumerate(texts)
             for i, a, b in sure_pairs([w for w, _, _ in words(text)])]
    joined, by_pair = _lookup(pairs, "string")
    firsts, seconds = [sorted({p.split(" ")[k] for p in joined}) for k in (0, 1)]

    w = F.col("w")
    spots = F.filter(F.transform(w, lambda x, i: F.when(x.isin(firsts), i)), lambda i: i.isNotNull())
    near = F.flatten(F.transform(spots, lambda i: F.transform(
        F.sequence(i + 1, i + 1 + BAND), lambda j: F.when(F.get(w, j).isin(seconds), F.struct(
            i.alias("at"), F.concat(F.get(w, i), F.lit(" "), F.get(w, j)).alias("pair"))))))
    met = F.filter(near, lambda p: p.isNotNull() & p["pair"].isin(joined))

    def voted(hits: Column, table: Column, key: str) -> Column:
        return F.flatten(F.transform(hits, lambda f: F.transform(
            F.element_at(table, f[key]), lambda v: F.struct(
                v["license_id"].alias("license_id"), v["variant"].alias("variant"),
                (f["at"] - v["place"]).alias("begin")))))

    tokens = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _tokens(F.col("text")).alias("w"))
    hashed = tokens.select("doc_id", "text", "w", _hashes(w).alias("hs"))
    places = F.array_distinct(F.concat(
        voted(_winnowed(F.col("hs"), hashes), by_hash, "h") if hashes else F.array(),
        voted(met, by_pair, "pair") if joined else F.array()))
    # behind an explode: a filter on a computed column would repeat all of it on the scan
    return (hashed.select("doc_id", "text", F.explode(F.array(places)).alias("places"))
            .where(F.size("places") > 0))


def align(template: list[str], found: list[str], band: int) -> tuple[int, int, int]:
    """Longest common subsequence of two word lists within a band around the diagonal:
    (matched words, first matched index in ``found``, last matched index)."""
    n, m = len(template), len(found)
    score = [[0] * (m + 1)]
    for i in range(1, n + 1):
        above, row, word = score[-1], [0] * (m + 1), template[i - 1]
        for j in range(max(1, i - band), min(m, i + band) + 1):
            if word == found[j - 1]:
                row[j] = above[j - 1] + 1
            else:
                up = above[j] if j - i < band else 0
                left = row[j - 1] if i - j < band else 0
                row[j] = up if up > left else left
        score.append(row)
    i, j = n, max(range(m + 1), key=score[n].__getitem__)
    matched, first, last = score[n][j], -1, -1
    while i and j and score[i][j]:
        if template[i - 1] == found[j - 1] and score[i][j] == score[i - 1][j - 1] + 1:
            last = j - 1 if last < 0 else last
            first = j - 1
            i, j = i - 1, j - 1
        elif score[i - 1][j] >= score[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return matched, first, last


def notices(text: str | None, places: list[tuple[str, int, int]],
            templates: dict[str, list[str]]) -> list[tuple]:
    """(license, variant, coverage, matched words, first and past last character) for the
    places (license, variant, first word) of one document; of overlapping spans the
    better covered, then the longer, then the first license by name stays."""
    doc = words(text)
    plain = [w for w, _, _ in doc]
    found = {}
    for name, variant, begin in places:
        template = [w for w, _, _ in words(templates[name][variant])]
        start = max(0, begin - BAND)
        window = plain[start:begin + len(template) + BAND]
        shift = begin - start
        matched, first, last = align([""] * shift + template, window, BAND)
        if template and matched >= COVERAGE * len(template):
            key = (name, variant, doc[start + first][1], doc[start + last][2])
            found[key] = max(found.get(key, (0.0, 0)), (matched / len(template), matched))
    ranked = sorted(found.items(), key=lambda x: (-x[1][0], -x[1][1], x[0]))
    kept: list[tuple] = []
    for (name, variant, a, b), (coverage, matched) in ranked:
        if all(b <= k[4] or a >= k[5] for k in kept):
            kept.append((name, variant, coverage, matched, a, b))
    return sorted(kept, key=lambda k: (k[4], k[0]))


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """``doc_id, license_id, variant, coverage, matched_words, start_char, end_char`` of each
    notice in each row of ``docs``.

    A notice is found if at least ``COVERAGE`` of a template's words stand in order, none
    more than ``BAND`` words off the place that the others give it; templates need two
    words.  Documents without words have no notice.  Repeated rows of one document give its
    notices once; a null doc_id is a document like any other.  Columns besides doc_id and
    text are ignored.
    """
    templates = templates or TEMPLATES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(doc_id, *n) for doc_id, text, places in batch.itertuples(index=False)
                    for n in notices(text, sorted((p["license_id"], p["variant"], p["begin"]) for p in places),
                                     templates)]
            frame = pd.DataFrame(rows, columns=columns)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    columns = ["doc_id", "license_id", "variant", "coverage", "matched_words", "start_char", "end_char"]
    return with_places(docs, templates).mapInPandas(
        run, "doc_id long, license_id string, variant int, coverage double, "
             "matched_words int, start_char int, end_char int").distinct()
