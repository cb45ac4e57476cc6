import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedweave.llm import licenses


@pytest.mark.parametrize("name, text", licenses.TEMPLATES)
def test_every_template_is_found(name, text):
    around = f"Some words before.\n{text}\nSome words after it, of no weight."
    found = licenses.scan(around)
    assert [f[0] for f in found] == [name]
    start, end = found[0][1:3]
    assert around[start:end].strip('."') in text and found[0][4:] == (0, 0)


@pytest.mark.parametrize(
    "text",
    [
        "Licensed under the Apache License, Version 1.1.",
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under the GNU General Public License, version 7.",
        "Drivers must hold a license, issued by the public office, version of 2024.",
        "The licence fee is subject to the terms of the contract.",
        "Released under the Foo License.",
        "license " * 500,
        "",
    ],
)
def test_other_wordings_are_not(text):
    assert licenses.scan(text) == []


def test_wording_differences_are_counted():
    text = "this source code form is subject to the following terms of the  Mozilla Public\nLicense, v. 2.0"
    assert [(f[0], f[4], f[5]) for f in licenses.scan(text)] == [("MPL-2.0", 0, 1)]
    text = licenses.TEMPLATES[4][1].replace("free of charge, ", "").replace("furnished", "given")
    ((name, _, _, _, missing, added),) = licenses.scan(text)
    assert (name, missing, added) == ("MIT", 4, 1)


def test_several_in_one_block():
    text = "Licensed under CC BY-NC 4.0. Released under the MIT License.\nLicensed under the Apache License, Version 2.0. And more."
    assert [f[0] for f in licenses.scan(text)] == ["CC-BY-NC-4.0", "MIT", "Apache-2.0"]
    far = "Licensed under CC BY-NC 4.0." + "\nline" * 50 + "\nReleased under the MIT License."
    assert [f[0] for f in licenses.scan(far)] == ["CC-BY-NC-4.0", "MIT"]


def test_tables(spark):
    rows = [(1, "Released under the MIT License."), (1, "Licensed under CC BY 4.0."), (2, None), (None, ""), (3, "word " * 60000 + "\nReleased under the MIT License.\n" * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"license": F.lit("x"), "start": F.lit(1)})
    found = sorted(map(tuple, licenses.with_licenses(df).select("doc_id", "n_notices", "licenses").collect()), key=str)
    assert found == sorted([(1, 2, "CC-BY-4.0 MIT"), (2, 0, ""), (None, 0, ""), (3, 2, "MIT")], key=str)
    spans = licenses.license_spans(df).where("doc_id = 3").orderBy("start").collect()
    text = rows[4][1]
    assert [text[r["start"] : r["end"]] for r in spans] == ["Released under the MIT License"] * 2
    assert licenses.with_licenses(df.where("false")).count() == 0


def test_spans_equal_plain_search(spark):
    """On the given documents notices stand verbatim: the spans are what a plain search finds."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    phrases = {t.strip("."): n for n, t in licenses.TEMPLATES}
    expected = []
    for r in docs.collect():
        for phrase, name in phrases.items():
            at = (r["text"] or "").find(phrase)
            while at >= 0:
                expected.append((r["doc_id"], name, at, at + len(phrase)))
                at = r["text"].find(phrase, at + 1)
    found = licenses.license_spans(docs).select("doc_id", "license", "start", "end").collect()
    assert expected and sorted(map(tuple, found)) == sorted(expected)


def test_block_length_hides_no_notice():
    """One line of 100 KB with one notice: the compressed size says nothing there."""
    filler = " ".join(f"word{chr(97 + k % 26)} and other text" for k in range(4000))
    for name, text in licenses.TEMPLATES:
        line = f"{filler} {text} {filler}"
        assert len(line) > 100_000
        assert [(f[0], f[4:]) for f in licenses.scan(line)] == [(name, (0, 0))], text


def test_gain_of_short_notices_is_noise(spark):
    """Documents of sf0.1 whose notices do not compress, as they are and in one line."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id in (2193, 3460, 5972)")
    for r in docs.collect():
        name = {2193: "MIT", 3460: "CC-BY-NC-4.0", 5972: "CC-BY-NC-4.0"}[r["doc_id"]]
        assert name in [f[0] for f in licenses.scan(r["text"])]
        assert name in [f[0] for f in licenses.scan(r["text"].replace("\n", " "))]


def test_near_miss_beside_a_notice():
    text = "Licensed under the Apache License, Version 1.1, or licensed under the Apache License, version 2.0. Licensed under CC BY 4.0 or CC BY-NC 4.0"
    assert [f[0] for f in licenses.scan(text)] == ["Apache-2.0", "CC-BY-4.0"]


@pytest.mark.parametrize("width", [20, 40, 76])
@pytest.mark.parametrize("prefix", ["", "# ", " * "])
@pytest.mark.parametrize("around", ["{}", "A line.\n\n{}", "{}\nA line.\n", "A line.\r\n{}\nA line."])
def test_line_ends_hide_no_notice(width, prefix, around):
    """Wrapped notices on the first line, the last line and in between, also as comments."""
    for name, text in licenses.TEMPLATES:
        lines = textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
        page = around.format("\n".join(prefix + line for line in lines))
        assert [(f[0], f[4:]) for f in licenses.scan(page)] == [(name, (0, 0))], page


def test_notice_on_the_first_line():
    text = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    assert [(f[0], f[1]) for f in licenses.scan(text)] == [("BSD", 0)]


def test_every_text_with_a_notice_is_looked_at(spark):
    """The test before the scan lets all wordings through, also with words missing and in capitals."""
    texts = []
    for _, text in licenses.TEMPLATES:
        words = text.upper().split()
        texts += [(" ".join(words[:k] + words[k + 1 :]).replace(" ", "\n"),) for k in range(len(words))]
    hit = [t for (t,) in texts if licenses.scan(t)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(hit)], "doc_id long, text string")
    assert hit and licenses.license_spans(docs).select("doc_id").distinct().count() == len(hit)


LATER = """This {} is free software; you can redistribute it and/or
modify it under the terms of the GNU {}General Public
License as published by the Free Software Foundation; either
version {} of the License, or (at your option) any later version."""
PUBLISHED = [
    ("GPL-2.0", LATER.format("program", "", "2")),
    ("GPL-3.0", LATER.format("program", "", "3")),
    ("LGPL-2.0", LATER.format("library", "Library ", "2")),
    ("LGPL-2.1", LATER.format("library", "Lesser ", "2.1")),
    ("LGPL-3.0", LATER.format("library", "Lesser ", "3")),
    ("AGPL-3.0", LATER.format("program", "Affero ", "3")),
    ("GPL-2.0", "you can redistribute it and/or modify\nit under the terms of the GNU General Public License version 2 as\npublished by the Free Software Foundation."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy"),
    ("CC0-1.0", "To the extent possible under law, the author of this small work of art has waived all copyright\nand related or neighboring rights to this work."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0\nwhich accompanies this distribution"),
    ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License\nVersion 1.1 (the \"License\"); you may not use this file except in\ncompliance with the License."),
    ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its\ncontributors may be used to endorse or promote products derived from\nthis software without specific prior written permission."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons\nAttribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("CC-BY-ND-2.0", "Licensed under CC BY-ND 2.0."),
]


@pytest.mark.parametrize("name, text", PUBLISHED)
def test_published_headers(name, text):
    assert [f[0] for f in licenses.scan(text)] == [name]
    assert [f[0] for f in licenses.scan("/*\n" + "".join(f" * {line}\n" for line in text.split("\n")) + " */")] == [name]


@pytest.mark.parametrize(
    "file, name",
    [("Apache-2.0", "Apache-2.0"), ("GPL-1", "GPL-1.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2", "LGPL-2.0"), ("LGPL-2.1", "LGPL-2.1"),
     ("LGPL-3", "LGPL-3.0"), ("MPL-1.1", "MPL-1.1"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"), ("GFDL-1.2", "GFDL-1.2"), ("GFDL-1.3", "GFDL-1.3")],
)
def test_whole_license_texts(file, name):
    path = Path("/usr/share/common-licenses", file)
    if not path.exists():
        pytest.skip("no license texts on this machine")
    assert {f[0] for f in licenses.scan(path.read_text())} == {name}


@pytest.mark.parametrize(
    "line, names",
    [
        ("// SPDX-License-Identifier: MIT", ["MIT"]),
        ("/* SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note */", ["GPL-2.0-only"]),
        ("# spdx-license-identifier: (Apache-2.0 OR MIT) AND LicenseRef-Own\nnext line", ["Apache-2.0", "MIT", "LicenseRef-Own"]),
        ("<!-- SPDX-License-Identifier:CC-BY-NC-SA-4.0--> OR MIT", ["CC-BY-NC-SA-4.0"]),
        ("Write SPDX-License-Identifier: MIT. Or not", ["MIT"]),
        ("SPDX-License-Identifier:", []),
    ],
)
def test_identifiers(spark, line, names):
    found = licenses.scan(line)
    assert [f[0] for f in found] == names
    assert all(line[f[1] : f[2]] == f[0] for f in found)
    docs = spark.createDataFrame([(1, line)], "doc_id long, text string")
    assert licenses.with_licenses(docs).first()["n_notices"] == len(names)


class SameSize:
    """A compressor for which nothing saves anything."""

    def compress(self, data):
        return data


def test_the_ranking_decides(monkeypatch):
    """Several templates fit the same words: the compressed sizes choose, and without them another one is reported."""
    short, long = [t for n, t in licenses.TEMPLATES if n == "Apache-2.0"][:2]
    text = f"Some words before. {long} Some words after."
    ((name, start, end, gain, *_),) = licenses.scan(text)
    assert (name, text[start:end]) == ("Apache-2.0", long) and gain > 0
    known, _ = licenses._templates(licenses.TEMPLATES)
    for t in known:
        monkeypatch.setattr(t, "squeeze", SameSize())
    monkeypatch.setattr(licenses.zstandard, "ZstdCompressor", lambda **_: SameSize())
    ((name, start, end, gain, *_),) = licenses.scan(text)
    assert (text[start:end], gain) == (short.strip("."), 0)


def test_every_window_meets_every_template_of_its_seed():
    words = "the free text licensed under cc by 4.0 and under the mit license".split()
    known, seeds = licenses._templates(licenses.TEMPLATES)
    ranked = licenses._ranked(words, licenses.TEMPLATES)
    assert {(k, i) for _, k, i in ranked} == {(k, i) for i, w in enumerate(words) if w in seeds for k, _ in seeds[w].places}
    assert [max(g, 0) for g, _, _ in ranked] == sorted((max(g, 0) for g, _, _ in ranked), reverse=True)


def test_seed_words_without_a_notice_end_soon():
    import time

    start = time.time()
    assert licenses.scan("gnu creative commons " * 20_000) == []
    assert licenses.scan(" ".join(f"gnu{'x' * (k % 7)} word{chr(97 + k % 26)} mit" for k in range(5_000))) == []
    assert time.time() - start < 30
