"""License scan by diagonal voting (operator 7).

Words are the matches of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after
lower-casing A-Z. Every rolling ``K``-gram of every document is joined in Spark
to the templates' positions. A match votes for its diagonal, document position
less template position; votes are summed by diagonal, neighbouring diagonals
(words put in or left out) are merged, and a merged span is verified by the
share of the template's positions that it covers and by its length. Each vote
also carries an independent second hash of the gram, which must agree.

A chain of diagonals that is too long for one notice (copies that follow each
other, stray grams beside a copy) is split: every diagonal that meets ``COVER``
by itself is a span, and what is left between them is searched by stretches of
at most ``LONGEST`` times the template's grams.

The short phrases are templates too; a phrase stands where one diagonal holds
all its grams. Longer templates are the usual notices and whole license texts,
of any length: the places that a diagonal holds are kept in blocks of ``BLOCK``
bits. A notice in a text adds its label where at least ``COVER`` of its grams are
found.

Defined results: null and empty texts have no words, no labels and score 0; a
phrase can start at one word only once; repeated rows are scanned each for
itself; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytewords import Hasher, alnum_table, cut, mix, pieces, text_buffers
from .common import kept_by_worker

K, NEAR, COVER, LONGEST = 2, 4, 0.7, 1.5
MARK, NO_TEMPLATE = 1, -1
#: Diagonals are neighbours within NEAR words, or one word in SLACK of a longer template.
SLACK = 20
#: Places in one mask, and votes from which a stretch is searched with arrays.
BLOCK, MANY = 62, 64

# Phrases and notices of public licenses, with their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache",
    "licensed under the apache license version 2 0": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this work is licensed under a creative commons attribution": "cc",
    "licensed under cc by": "cc",
    "licensed under cc by nc 4 0": "cc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
}
# Whole texts of public licenses, with their labels.
TEXTS = {
    """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
    documentation files the software to deal in the software without restriction including without limitation the
    rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
    persons to whom the software is furnished to do so subject to the following conditions the above copyright notice
    and this permission notice shall be included in all copies or substantial portions of the software the software is
    provided as is without warranty of any kind express or implied including but not limited to the warranties of
    merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright
    holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise
    arising from out of or in connection with the software or the use or other dealings in the software""": "mit",
    """redistribution and use in source and binary forms with or without modification are permitted provided that the
    following conditions are met 1 redistributions of source code must retain the above copyright notice this list of
    conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice
    this list of conditions and the following disclaimer in the documentation and or other materials provided with the
    distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission this software is provided by
    the copyright holders and contributors as is and any express or implied warranties including but not limited to the
    implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the
    copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential
    damages including but not limited to procurement of substitute goods or services loss of use data or profits or
    business interruption however caused and on any theory of liability whether in contract strict liability or tort
    including negligence or otherwise arising in any way out of the use of this software even if advised of the
    possibility of such damage""": "bsd",
    """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
    granted provided that the above copyright notice and this permission notice appear in all copies the software is
    provided as is and the author disclaims all warranties with regard to this software including all implied
    warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or
    consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of
    contract negligence or other tortious action arising out of or in connection with the use or performance of this
    software""": "isc",
    """this software is provided as is without any express or implied warranty in no event will the authors be held
    liable for any damages arising from the use of this software permission is granted to anyone to use this software
    for any purpose including commercial applications and to alter it and redistribute it freely subject to the
    following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote
    the original software if you use this software in a product an acknowledgment in the product documentation would be
    appreciated but is not required 2 altered source versions must be plainly marked as such and must not be
    misrepresented as being the original software 3 this notice may not be removed or altered from any source
    distribution""": "zlib",
    """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use
    compile sell or distribute this software either in source code form or as a compiled binary for any purpose
    commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors
    of this software dedicate any and all copyright interest in the software to the public domain we make this
    dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this
    dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software
    under copyright law""": "unlicense",
}
PHRASE_COUNT = len(PHRASES)


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of every K-gram, each text's first gram, and each text's number of words."""
    hasher = kept_by_worker(("hasher",), Hasher)
    starts, ends, first = cut(data, offs, alnum_table())
    words = hasher.spans(data, starts, ends)
    count = np.diff(first)
    n = len(words) - K + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64), count
    gram, check = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for j in range(K):
        c = mix(np.array([2 * j + 1, 2 * j + 2], np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)
        gram += words[j : j + n] * c[0]
        check += mix(words[j : j + n] * c[1])
    text = np.repeat(np.arange(len(count)), count)
    whole = np.flatnonzero(text[:n] == text[K - 1 :])
    return mix(gram[whole]).view(np.int64), mix(check[whole]).view(np.int64), np.searchsorted(text[whole], np.arange(len(offs))), count


def templates(spark: SparkSession, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """gram, check, template, place, grams, label: a row for each position of each template, and the row that every document meets."""
    rows = [(MARK, MARK, NO_TEMPLATE, 0, 1, "")]
    for number, (text, label) in enumerate([*phrases.items(), *notices.items()]):
        gram, check, _, _ = _grams(*text_buffers(pa.array([text])))
        if not len(gram):
            raise ValueError(f"a template needs {K} words: {text!r}")
        rows += [(int(g), int(c), number, i, len(gram), label) for i, (g, c) in enumerate(zip(gram, check))]
    return spark.createDataFrame(rows, "gram long, check long, template int, place int, grams int, label string")


Span = tuple[int, int, float]


def _stretch(votes: list[tuple[int, int]], i: int, grams: int) -> Span:
    """First and last gram and cover of the best neighbouring diagonals in the longest stretch from vote ``i``."""
    stop, inside = votes[i][0] + int(LONGEST * grams), []
    j = bisect_left(votes, (stop, -1), i)
    if j - i > MANY:
        at, place = np.array(votes[i:j]).T
        order = np.argsort(at - place, kind="stable")
        at, place = at[order], place[order]
        group = np.concatenate([[0], np.cumsum(np.diff(at - place) > max(NEAR, grams // SLACK))])
        begins = np.flatnonzero(np.diff(group, prepend=-1))
        low, high = np.minimum.reduceat(at, begins), np.maximum.reduceat(at, begins)
        cover = np.bincount(np.unique(group * grams + place) // grams, minlength=len(begins)) / grams
        return max(((int(a), int(b), float(c)) for a, b, c in zip(low, high, cover)), key=_worth)
    for k in range(i, j):
        at, place = votes[k]
        inside.append((at - place, at, place))
    inside.sort()
    best, held = (0, 0, 0.0), []
    for k, vote in enumerate(inside):
        held.append(vote)
        if k + 1 == len(inside) or inside[k + 1][0] - vote[0] > max(NEAR, grams // SLACK):
            ats = [at for _, at, _ in held]
            best = max(best, (min(ats), max(ats), len({place for _, _, place in held}) / grams), key=_worth)
            held = []
    return best


def _worth(span: Span) -> tuple[float, int, int]:
    return span[2], span[0] - span[1], -span[0]


def _apart(votes: list[tuple[int, int]], grams: int) -> list[Span]:
    """Spans that meet COVER and do not overlap; the best of overlapping ones."""
    out, i = [], 0
    while i < len(votes):
        top = here = _stretch(votes, i, grams)
        if here[2] < COVER:
            i += 1
            continue
        j = i + 1
        while j < len(votes) and votes[j][0] <= here[1]:
            top = max(top, _stretch(votes, j, grams), key=_worth)
            j += 1
        out += [*_apart([v for v in votes[i:j] if v[0] < top[0]], grams), top]
        while i < len(votes) and votes[i][0] <= top[1]:
            i += 1
    return out


def split_chain(diagonals: list[tuple[int, int, int]], grams: int) -> tuple[float, list[Span]]:
    """Best cover of any stretch, and all spans, of a chain of (diagonal, block of places, places seen in it) that is too long for one notice."""
    whole: dict[int, int] = {}
    for d, block, seen in diagonals:
        whole[d] = whole.get(d, 0) | seen << block * BLOCK
    votes = sorted((d + block * BLOCK + p, block * BLOCK + p) for d, block, seen in diagonals for p in range(seen.bit_length()) if seen >> p & 1)
    best = max(_stretch(votes, i, grams)[2] for i in range(len(votes)))
    alone = sorted((d + (seen & -seen).bit_length() - 1, d + seen.bit_length() - 1, seen.bit_count() / grams) for d, seen in whole.items() if seen.bit_count() / grams >= COVER)
    spans, rest, k, reach = list(alone), [], 0, -1
    for at, place in votes:
        if k < len(alone) and at >= alone[k][0]:
            # a span does not go on behind a copy that stands by itself
            spans += _apart(rest, grams)
            rest = []
            while k < len(alone) and at >= alone[k][0]:
                reach = max(reach, alone[k][1])
                k += 1
        if at > reach:
            rest.append((at, place))
    return best, sorted([*spans, *_apart(rest, grams)])


FOUND = "array<struct<template: int, label: string, first: int, last: int, cover: double, best: double>>"


def _split(chains):
    out = []
    for c in chains:
        best, spans = split_chain(c["diagonals"], c["grams"])
        out += [(c["template"], c["label"], *s, best) for s in spans or [(None, None, None)]]
    return out


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES | TEXTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: row, doc_id, n_words, spans (template, label, phrase or notice, first and last word, share covered)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offs = text_buffers(batch.column(1))
            for i, j, part, at in pieces(data, offs):
                gram, check, first, words = _grams(part, at)
                # the mark comes last in each list
                ends = first[1:]
                gram, check = np.insert(gram, ends, MARK), np.insert(check, ends, MARK)
                bounds = pa.array((first + np.arange(j - i + 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays([pa.array(gram), pa.array(check)], names=["gram", "check"]))
                yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(j - i)), batch.column(0).slice(i, j - i), pa.array(words.astype(np.int64)), lists], names=["row", "doc_id", "n_words", "grams"])
                row += j - i

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    every = rows.mapInArrow(run, f"row long, doc_id {kind}, n_words long, grams array<struct<gram: long, check: long>>")
    grams = every.select("row", "doc_id", "n_words", F.posexplode("grams").alias("at", "g")).select("row", "doc_id", "n_words", "at", F.col("g.gram").alias("gram"), F.col("g.check").alias("check"))
    # the templates are a given list, a row for each word of them
    votes = grams.join(F.broadcast(templates(docs.sparkSession, phrases, notices)), ["gram", "check"])
    # the places that a diagonal holds, in blocks of bits
    diagonals = (
        votes.withColumns({"diagonal": F.when(F.col("template") == NO_TEMPLATE, 0).otherwise(F.col("at") - F.col("place")), "block": F.expr(f"cast(place div {BLOCK} as int)")})
        .groupBy("row", "doc_id", "n_words", "template", "label", "grams", "diagonal", "block")
        .agg(F.bit_or(F.expr(f"shiftleft(1L, place % {BLOCK})")).alias("seen"), F.min("at").alias("first"), F.max("at").alias("last"))
    )
    notice = F.col("template") >= len(phrases)
    order = Window.partitionBy("row", "template").orderBy("diagonal", "block")
    # a phrase stands on one diagonal; a notice's neighbouring diagonals are one span
    step = F.col("diagonal") - F.lag("diagonal").over(order)
    new = step.isNull() | (step > F.when(notice, F.greatest(F.lit(NEAR), F.expr(f"grams div {SLACK}"))).otherwise(0))
    span_of = ["row", "doc_id", "n_words", "template", "label", "grams", "span"]
    merged = (
        diagonals.withColumn("span", F.sum(new.cast("int")).over(order))
        .groupBy(*span_of, "block")
        .agg(F.bit_or("seen").alias("seen"), F.min("first").alias("first"), F.max("last").alias("last"), F.collect_list(F.struct("diagonal", "block", "seen")).alias("diagonals"))
        .groupBy(*span_of)
        .agg((F.sum(F.bit_count("seen")) / F.first("grams")).alias("cover"), F.min("first").alias("first"), F.max("last").alias("last"), F.flatten(F.collect_list("diagonals")).alias("diagonals"))
    )
    short = F.col("last") - F.col("first") + 1 <= LONGEST * F.col("grams")
    verified = F.when(F.col("template") == NO_TEMPLATE, F.lit(False)).when(notice, short & (F.col("cover") >= COVER)).otherwise(F.col("cover") == 1)
    span = lambda c, notice: F.struct(c("template").alias("template"), c("label").alias("label"), notice.alias("notice"), c("first").alias("first_word"), (c("last") + K - 1).alias("last_word"), c("cover").alias("cover"))
    each = merged.groupBy("row", "doc_id", "n_words").agg(
        F.collect_list(F.when(verified, span(F.col, notice))).alias("spans"),
        F.max(F.when((F.col("template") != NO_TEMPLATE) & short, F.col("cover"))).alias("best"),
        F.collect_list(F.when(~short, F.struct("template", "label", "grams", "diagonals"))).alias("chains"),
    )
    split = each.withColumn("found", F.udf(_split, FOUND)("chains"))
    more = F.transform(F.filter("found", lambda s: s["first"].isNotNull()), lambda s: span(lambda n: s[n], F.lit(True)))
    return split.select(
        "row", "doc_id", "n_words", F.concat("spans", more).alias("spans"),
        F.greatest("best", F.array_max(F.transform("found", lambda s: s["best"]))).alias("best"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """Contract columns per document."""
    found = scan(docs)
    base = F.filter("spans", lambda s: ~s["notice"])
    starts = F.transform(base, lambda s: s["first_word"])
    joined = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
