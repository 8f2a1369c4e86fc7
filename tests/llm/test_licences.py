"""Licence digests against a plain reading of the rules."""

import pathlib

import pytest

from assayframe.llm import licences

MIT = dict(licences.KNOWN[:5])["MIT"]


def test_table(spark):
    wrapped = "Copyright (c) 2020 Some One\n(c) 2019, Other\n\n" + MIT.replace(", ", ",\n   ").upper()
    rows = [
        (1, None), (2, ""), (3, "..."), (4, wrapped), (5, MIT.replace("license", "licence") + " And more."),
        (6, "text\n\t* Released under the MIT licence!\r\nmore\nLicensed under CC BY NC 4.0\nreleased under the mit license"),
        (7, "released under the MIT License. And so on"), (8, "© 2021 Me\nCopyright 1999 by You"), (9, "All Rights Reserved"),
        (4, wrapped), (6, "other text of the same id"), (None, "All rights reserved."), (10, "filler line\n" * 50_000 + "All rights reserved."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as notices", "1 as digest")
    got = licences.scan(docs, licences.known_licences(spark))
    assert got.columns == ["doc_id", "text", "digest", "license_id", "notices", "n_notices"]
    assert sorted((str(r["doc_id"]), r["license_id"] or "", ",".join(r["notices"]), r["n_notices"]) for r in got.collect()) == sorted([
        ("1", "", "", 0), ("2", "", "", 0), ("3", "", "", 0), ("4", "MIT", "", 0), ("4", "MIT", "", 0), ("5", "", "", 0),
        ("6", "", "CC-BY-NC-4.0,MIT", 3), ("6", "", "", 0), ("7", "", "", 0), ("8", "", "", 0), ("9", "all-rights-reserved", "all-rights-reserved", 1),
        ("None", "all-rights-reserved", "all-rights-reserved", 1), ("10", "", "all-rights-reserved", 1),
    ])
    assert licences.scan(docs.limit(0), licences.known_licences(spark)).count() == 0
    none = licences.scan(docs, licences.known_licences(spark).limit(0))
    assert none.count() == len(rows) and none.filter("license_id is not null or n_notices > 0").count() == 0


def test_known_licences_are_apart(spark):
    digests = licences.licence_digests(licences.known_licences(spark)).collect()
    assert len(digests) == len(licences.KNOWN)
    assert {r["license_id"] for r in digests} == {k for k, _ in licences.KNOWN}


@pytest.mark.parametrize("broadcast", [0, 10_000])
def test_many_licences_are_joined_alike(spark, monkeypatch, broadcast):
    monkeypatch.setattr(licences, "BROADCAST_ROWS", broadcast)
    docs = spark.createDataFrame([(i, f"Licence text number {i % 7}") for i in range(50)], "doc_id long, text string")
    known = spark.createDataFrame([(f"L{i}", f"license, TEXT: number {i}") for i in range(5)], "license_id string, text string")
    got = {r["doc_id"]: r["license_id"] for r in licences.scan(docs, known).collect()}
    assert got == {i: f"L{i % 7}" if i % 7 < 5 else None for i in range(50)}


def test_whole_texts_are_known(spark):
    """Whole texts with other breaks, case and copyright lines; the small change of a word is no match."""
    starts = {
        "Apache-2.0": "Apache License\nVersion 2.0", "GPL-1.0": "GNU GENERAL PUBLIC LICENSE\nVersion 1", "GPL-2.0": "GNU GENERAL PUBLIC LICENSE\nVersion 2",
        "GPL-3.0": "GNU GENERAL PUBLIC LICENSE\nVersion 3", "LGPL-2.0": "GNU LIBRARY GENERAL PUBLIC LICENSE\nVersion 2",
        "LGPL-2.1": "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1", "LGPL-3.0": "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3",
        "MPL-2.0": "Mozilla Public License Version 2.0", "CC0-1.0": "Creative Commons Legal Code CC0 1.0 Universal",
        "Artistic-1.0-Perl": 'The "Artistic License"', "GFDL-1.3": "GNU Free Documentation License\nVersion 1.3", "MIT": "The MIT License (MIT)",
    }
    whole = {}
    for k, t in licences.KNOWN:
        if k in starts and " ".join(t.split()).startswith(" ".join(starts[k].split())):
            whole[k] = max(whole.get(k, ""), t, key=len)
    assert set(whole) == set(starts)
    rows = [(k, "(c) 2020, Some One\n" + t.replace("\n", "  \r\n\r\n").upper()) for k, t in whole.items()]
    rows += [("not " + k, t + "\nAnd more.") for k, t in whole.items()]
    got = {r["doc_id"]: r["license_id"] for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string"), licences.known_licences(spark)).collect()}
    assert got == {k: k for k in whole} | {"not " + k: None for k in whole}


@pytest.mark.parametrize("name,licence", [("Apache-2.0", "Apache-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2.1", "LGPL-2.1"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")])
def test_copies_of_the_system_are_known(spark, name, licence):
    path = pathlib.Path("/usr/share/common-licenses", name)
    if not path.exists():
        pytest.skip("this system has no copy")
    docs = spark.createDataFrame([(1, path.read_text())], "doc_id long, text string")
    assert licences.scan(docs, licences.known_licences(spark)).first()["license_id"] == licence
