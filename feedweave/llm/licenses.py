"""License scans by conditional compression with templates as raw dictionaries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweave.llm.common import small_batches

# Notices as their licenses word them (SPDX name, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
)
_GNU = "This work is licensed under the GNU {}General Public License, version {}."
_GNU_LATER = (
    "you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
_GNU_ONLY = (
    "it under the terms of the GNU {}General Public License{} version {} as published by the Free Software Foundation"
)
_GNU_TITLE = "GNU {}GENERAL PUBLIC LICENSE Version {}"
_CC = "This work is licensed under a Creative Commons {} {} License."
_CC_TITLE = "Creative Commons {} {} Public License"
_CC_KINDS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"4.0": "4.0 International", "3.0": "3.0 Unported", "2.5": "2.5 Generic", "2.0": "2.0 Generic"}
_FAMILY = (
    ("GPL-1.0", "", "1", "February 1989"),
    ("GPL-2.0", "", "2", "June 1991"),
    ("GPL-3.0", "", "3", "29 June 2007"),
    ("LGPL-2.0", "Library ", "2", "June 1991"),
    ("LGPL-2.1", "Lesser ", "2.1", "February 1999"),
    ("LGPL-3.0", "Lesser ", "3", "29 June 2007"),
    ("AGPL-3.0", "Affero ", "3", "19 November 2007"),
)
# The headers that the usual licenses ask for, and what their whole texts begin with or have alone.
TEMPLATES += tuple(
    (name, text)
    for name, kind, number, date in _FAMILY
    for text in (
        _GNU.format(kind, number),
        _GNU_LATER.format(kind, number),
        _GNU_ONLY.format(kind, ",", number),
        f"{_GNU_TITLE.format(kind.upper(), number)}, {date}",
    )
    if (name, text) not in TEMPLATES
)
TEMPLATES += tuple(
    (f"CC-{kind}-{version}", text)
    for kind, words in _CC_KINDS.items()
    for version, full in _CC_VERSIONS.items()
    for text in (
        _CC.format(words, full),
        *([_CC_TITLE.format(words, full)] if version == "4.0" else [f"Creative Commons Legal Code {words} {full}"]),
        *([f"Licensed under CC {kind} {version}."] if kind.count("-") < 2 else []),
    )
    if (f"CC-{kind}-{version}", text) not in TEMPLATES
)
TEMPLATES += (
    ("CC0-1.0", "waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    (
        "MPL-1.1",
        'The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not '
        "use this file except in compliance with the License.",
    ),
    ("MPL-1.1", "MOZILLA PUBLIC LICENSE Version 1.1 1. Definitions"),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("EPL-1.0", "are made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL-2.0", "are made available under the terms of the Eclipse Public License v. 2.0"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("Artistic-2.0", "The Artistic License 2.0"),
    *(
        (
            f"GFDL-{number}",
            "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
            f"Documentation License, Version {number} or any later version published by the Free Software Foundation",
        )
        for number in ("1.1", "1.2", "1.3")
    ),
)
# Words that tell licenses apart: none may differ. Numbers are such words too.
KEYS = frozenset(
    "apache mit gnu gpl lgpl agpl lesser affero mozilla mpl bsd cc by sa nc nd creative commons attribution "
    "sharealike noncommercial noderivatives eclipse boost artistic".split()
)
LEAST_COVER = 0.9  # share of a template's words that must be there in order
# The same for windows compressed plainly and with a template, so that sizes differ by the template alone.
SIZES = zstandard.ZstdCompressionParameters(
    window_log=17, chain_log=12, hash_log=12, search_log=4, min_match=3, target_length=48, strategy=zstandard.STRATEGY_BTOPT,
    write_content_size=False, write_checksum=False, write_dict_id=False,
)
_WORD = re.compile(r"[^\W\d_]+|\d+(?:\.\d+)*")

_SPDX = re.compile(r"SPDX-License-Identifier:", re.IGNORECASE)
_SPDX_PART = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.:+-]*)")


def _is_key(word: str) -> bool:
    return word in KEYS or word[0].isdigit()


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.words = [w.lower() for w in _WORD.findall(text)]
        self.distinct = frozenset(self.words)
        self.may_miss = sum((k + 1) <= (1 - LEAST_COVER) * len(self.words) for k in range(len(self.words)))
        self.room = max(3, len(self.words) // 4)
        self.keys = frozenset(filter(_is_key, self.words))
        # a notice holds one of the seeds: either a word that must be there, or one more than may be missing
        must = self.keys if self.may_miss else self.distinct
        by_length = sorted((w for w in must or self.distinct if not w[0].isdigit()), key=lambda w: (-len(w), w))
        self.seeds = by_length[: 1 if must else self.may_miss + 1]
        whole = zstandard.ZstdCompressionDict(" ".join(self.words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.squeeze = zstandard.ZstdCompressor(compression_params=SIZES, dict_data=whole)


class Seed:
    """The templates that hold a seed word, with its places in them, and how far a window around it reaches."""

    def __init__(self, word: str, known: list[Template]):
        self.places = [(k, [j for j, w in enumerate(t.words) if w == word]) for k, t in enumerate(known) if word in t.seeds]
        self.before = max(max(at) + known[k].room for k, at in self.places)
        self.after = max(len(known[k].words) - min(at) + known[k].room for k, at in self.places)


@lru_cache(maxsize=4)
def _templates(texts: tuple) -> tuple[list[Template], dict[str, Seed]]:
    """The templates and their seed words."""
    known = [Template(name, text) for name, text in texts]
    return known, {word: Seed(word, known) for word in {w for t in known for w in t.seeds}}


def seed_pattern(templates: tuple = TEMPLATES) -> str:
    """What a text must hold to have a notice."""
    return f"(?i)(?<![a-z])(?:spdx-license-identifier|{'|'.join(sorted(_templates(templates)[1]))})(?![a-z])"


def _align(want: list[str], have: list[str], gap: int) -> list[tuple[int, int]]:
    """Pairs (place in ``want``, place in ``have``) of the cheapest alignment that starts at both starts.

    A word of ``have`` passed over costs 1, one of ``want`` left out ``gap`` + 1, so that gaps are
    bridged; key words cost more than all others together. What follows the last pair is free in ``have``.
    """
    same = 0
    while same < min(len(want), len(have)) and want[same] == have[same]:
        same += 1
    pairs = [(k, k) for k in range(same)]
    want, have = want[same:], have[same:]
    if not want:
        return pairs
    far = (gap + 2) * (len(want) + len(have))
    skip = [far if _is_key(w) else 1 for w in have]
    row = [0]
    for cost in skip:
        row.append(row[-1] + cost)
    steps = []
    for w in want:
        lose = far if _is_key(w) else gap + 1
        now, step = [row[0] + lose], ["u"]
        for x, h in enumerate(have):
            up, left = row[x + 1] + lose, now[x] + skip[x]
            if w == h and row[x] <= up and row[x] <= left:
                now.append(row[x])
                step.append("d")
            elif up <= left:
                now.append(up)
                step.append("u")
            else:
                now.append(left)
                step.append("l")
        row = now
        steps.append(step)
    k, x = len(want), row.index(min(row))
    late = []
    while k:
        step = steps[k - 1][x]
        if step == "d":
            late.append((same + k - 1, same + x - 1))
        k -= step != "l"
        x -= step != "u"
    return pairs + late[::-1]


def _confirm(template: Template, words: list[str], i: int, j: int) -> tuple[int, int, int, int] | None:
    """The notice whose word j is word i of the text: first, last, missing and added words; None if it is not this license.

    It may hold as many added words as the template has words.
    """
    t, room = template.words, template.room
    ahead = words[i + 1 : i + 1 + 2 * (len(t) - j) + room]
    back = words[max(0, i - 2 * (j + 1) - room) : i][::-1]
    there = {words[i], *ahead, *back}
    if not template.keys <= there or len(template.distinct - there) > template.may_miss:
        return None
    right = [(j + 1 + a, i + 1 + b) for a, b in _align(t[j + 1 :], ahead, room)]
    left = [(j - 1 - a, i - 1 - b) for a, b in _align(t[:j][::-1], back, room)]
    pairs = [*left[::-1], (j, i), *right]
    # stray matches far from the seed do not belong to the notice
    first = last = len(left)
    while first and pairs[first][1] - pairs[first - 1][1] - 1 <= room:
        first -= 1
    while last + 1 < len(pairs) and pairs[last + 1][1] - pairs[last][1] - 1 <= room:
        last += 1
    used = pairs[first : last + 1]
    start, end = used[0][1], used[-1][1] + 1
    same_text, same_words = {a for a, _ in used}, {b for _, b in used}
    missing = [w for k, w in enumerate(t) if k not in same_text]
    added = [words[k] for k in range(start, end) if k not in same_words]
    if len(missing) > template.may_miss or any(map(_is_key, missing + added)):
        return None
    return start, end, len(missing), len(added)


def identifiers(text: str) -> Iterator[tuple[str, int, int]]:
    """The licenses of all SPDX-License-Identifier lines, as written; exceptions (after WITH) are none."""
    for m in _SPDX.finditer(text):
        at, after = m.end(), "("
        while part := _SPDX_PART.match(text, at):
            word, at = part.group(1), part.end()
            operator = word.upper() in ("AND", "OR", "WITH")
            ended = after not in ("(", "AND", "OR", "WITH")
            if word == ")" or operator:
                if not ended:
                    break
            elif ended:
                break
            elif word != "(" and after != "WITH":
                name = word.rstrip(".:-")
                yield name, part.start(1), part.start(1) + len(name)
                if len(name) < len(word):
                    break
            after = word.upper() if operator else word


def _ranked(words: list[str], templates: tuple) -> list[tuple[int, int, int]]:
    """(reduction, template, seed place) of every candidate window with each template that shares its seed, best first.

    The reduction is the size of the window compressed plainly less its size with the template as
    raw dictionary. Windows without a reduction come last, in the order of the templates. Equal windows are compressed once.
    """
    known, seeds = _templates(templates)
    plain = zstandard.ZstdCompressor(compression_params=SIZES)
    sizes: dict[tuple[str, bytes], list[int]] = {}
    ranked = []
    for i, word in enumerate(words):
        seed = seeds.get(word)
        if seed is None:
            continue
        data = " ".join(words[max(0, i - seed.before) : i + seed.after]).encode()
        saved = sizes.get((word, data))
        if saved is None:
            whole = len(plain.compress(data))
            saved = sizes[word, data] = [whole - len(known[k].squeeze.compress(data)) for k, _ in seed.places]
        ranked += [(gain, k, i) for gain, (k, _) in zip(saved, seed.places)]
    return sorted(ranked, key=lambda r: (-max(r[0], 0), r[1], r[2]))


def scan(text: str, templates: tuple = TEMPLATES) -> list[tuple[str, int, int, int, int, int]]:
    """(license, start, end, bytes saved, missing words, added words) of every notice in the whole text.

    SPDX identifiers save, miss and add nothing.
    """
    known, seeds = _templates(templates)
    found = [(*hit, 0, 0, 0) for hit in identifiers(text)]
    spans = [m.span() for m in _WORD.finditer(text)]
    words = [text[x:y].lower() for x, y in spans]
    places = {(word, k): at for word, seed in seeds.items() for k, at in seed.places}
    taken = bytearray(len(words))
    for gain, k, i in _ranked(words, templates):
        if taken[i]:
            continue
        tried = [p for p in (_confirm(known[k], words, i, j) for j in places[words[i], k]) if p]
        if tried:
            first, last, missing, added = min(tried, key=lambda p: (p[2] + p[3], p[0]))
            if not any(taken[first:last]):
                taken[first:last] = b"\1" * (last - first)
                found.append((known[k].name, spans[first][0], spans[last - 1][1], gain, missing, added))
    return sorted(found, key=lambda f: f[1:3])


def license_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple = TEMPLATES) -> DataFrame:
    """One row per license notice: id, ``license``, ``start``, ``end`` (code points), ``gain``, ``missing``, ``added``.

    Candidates are windows of words around every seed word of a template, as long as the longest template that has it;
    lines do not matter. Every window is compressed plainly and with each of these templates as raw zstandard
    dictionary, and all pairs are ranked by the bytes saved, ``gain``. Down this ranking a pair is confirmed on words: at
    least 90 % of the template's words in order, at most as many added ones, and no difference in names, numbers or
    other key words. What overlaps a notice confirmed before is left out, so of templates that fit the same words the one
    that saves most stays. A gain of zero or below ranks last and excludes nothing.
    The licenses of SPDX-License-Identifier lines are reported as written, whatever the templates.
    Null and empty texts give no rows, repeated rows repeat theirs; other columns are dropped.
    """
    small_batches(docs.sparkSession)

    def scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for k, t in enumerate(batch.column("t").to_pylist()):
                hits = scan(t, templates)
                ids += [k] * len(hits)
                rows += hits
            kinds = [pa.string(), *[pa.int64()] * 5]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(ids, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                names=["id", "license", "start", "end", "gain", "missing", "added"],
            )

    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).where(F.col("t").rlike(seed_pattern(templates)))
    kind = slim.schema["id"].dataType.simpleString()
    found = slim.mapInArrow(scan_all, f"id {kind}, license string, start long, end long, gain long, missing long, added long")
    return found.withColumnRenamed("id", id_col)


def with_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple = TEMPLATES) -> DataFrame:
    """One row per id: ``n_notices`` and ``licenses``, the names found, sorted, separated by blanks (empty: none).

    Rows that repeat an id are taken together; null ids are one id.
    """
    hits = license_spans(docs, id_col, text, templates).select(id_col, "license")
    every = docs.select(id_col, F.lit(None).cast("string").alias("license")).union(hits)
    return every.groupBy(id_col).agg(
        F.count("license").alias("n_notices"), F.array_join(F.array_sort(F.collect_set("license")), " ").alias("licenses")
    )
