"""Families and versions of licences."""

from pathlib import Path

from pisteflow.llm import licenses

WORK = "This work is licensed under "


def test_families_are_told_apart(spark):
    want = {
        WORK + "the GNU Lesser General Public License, version 3.": "lgpl-3.0",
        WORK + "the GNU General Public License, version 2.": "gpl-2.0",
        WORK + "the GNU General Public License, version 3.": "gpl-3.0-line",
        WORK + "the GNU Affero General Public License, version 3.": "agpl-3.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0-line",
        "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc-sa-4.0",
        "Licensed under CC BY 4.0.": "cc-by-4.0",
        WORK + "a Creative Commons Attribution-NonCommercial 4.0 International License.": "cc-by-nc-4.0",
        "Released under the MIT License.": "mit-line",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0-line",
        "SPDX-License-Identifier: MPL-2.0": "mpl-2.0-spdx",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "lgpl-2.1-or-later",
        licenses.TEMPLATES["zlib"]: "zlib",
        licenses.TEMPLATES["unlicense"]: "unlicense",
        licenses.TEMPLATES["bsl-1.0"]: "bsl-1.0",
    }
    texts = list(want)
    got = licenses.findings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    names = {k: [r.license for r in got if r.doc_id == k] for k in range(len(texts))}
    for k, t in enumerate(texts):
        assert len(names[k]) == 1 and names[k][0].startswith(want[t]), (t, names[k])


def test_unknown_versions_and_families_have_no_name(spark):
    texts = [WORK + "the GNU General Public License, version 7.", WORK + "the GNU Special General Affero Public License, version 2.", "Licensed under CC BY-NC 7.0."]
    assert licenses.findings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count() == 0


def test_whole_texts(spark):
    files = sorted((Path(licenses.__file__).parent / "license_texts").glob("*.txt"))
    rows = [(f.stem, "Some words. " + f.read_text() + " More words.") for f in files]
    got = {}
    for r in licenses.findings(spark.createDataFrame(rows, "doc_id string, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.coverage))
    assert len(files) == 13 and all((f"{s}-text", 1.0) in got[s] for s, _ in rows)
