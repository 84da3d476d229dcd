from __future__ import annotations

import textwrap

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from apptlake.llm.license_texts import BODIES
from apptlake.llm.licenses import TEMPLATES, THRESHOLD, Scanner, bigrams, license_scan, units
from apptlake.llm.oracle import ORACLE
from tools.check import rows_of

SF_DIR = "/root/testdata/sf0.01"
SCANNER = Scanner(TEMPLATES, THRESHOLD)
FULL = Scanner(TEMPLATES, THRESHOLD, BODIES)


def plain(text):
    """Every unit against every template."""
    found = {}
    for kind, number, unit in units(text):
        own = bigrams(unit)
        best = None
        for name in sorted(TEMPLATES):
            for template in map(bigrams, TEMPLATES[name]):
                dice = 2 * len(own & template) / (len(own) + len(template))
                if 100 * dice >= THRESHOLD - 1e-9 and (best is None or dice > best[0]):
                    best = dice, name
        if best and (best[1] not in found or best[0] > found[best[1]][0]):
            found[best[1]] = best[0], kind, number
    return found


PIECES = st.sampled_from([
    *(t for texts in TEMPLATES.values() for t in texts), "This work is licensed under CC BY-NC 4.0.",
    "Some prose. More of it!", "\n", "\n\n", " ", "LICENSED under the   MIT license", "All rights", "é",
])


@settings(max_examples=150, deadline=None)
@given(st.lists(PIECES, max_size=6))
def test_size_bounds_lose_no_match(pieces):
    text = "".join(pieces)
    assert SCANNER.scan(text) == plain(text)


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_each_licence_is_found_in_running_text(name):
    for template in TEMPLATES[name]:
        for text in (template, f"A first line.\n{template}\nAnd a last one.", f"Prose.\n\n{template.upper()}\n\nEnd."):
            assert SCANNER.scan(text)[name][0] == 1.0


def wrapped(text, mark="", width=60):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_notices_wrapped_inside_a_paragraph_are_found():
    for name, template in (("mit", TEMPLATES["mit"][2]), ("apache-2.0", TEMPLATES["apache-2.0"][2]), ("bsd-3-clause", BODIES["bsd-3-clause"][0])):
        for mark in ("", "# ", " * "):
            text = wrapped(" ".join(f"prose{n}" for n in range(300)) + " " + template + " And more of it.", mark)
            assert SCANNER.scan(text) == {}
            found = FULL.find(text)
            assert set(found) == {name} and found[name][0] > 0.99 and found[name][1] == "window"


@pytest.mark.parametrize("name", sorted(BODIES))
def test_whole_licences_are_found_in_their_files(name):
    for body in BODIES[name]:
        text = f"#!/bin/sh\n# Copyright (c) 2020 Somebody\n#\n{wrapped(body, '# ')}\n#\nset -e\necho done\n"
        assert FULL.find(text)[name][0] > 0.9


def test_a_bsd_2_file_parted_by_blank_lines_is_that_alone():
    body = BODIES["bsd-2-clause"][0].replace("1. Redis", "\n\n1. Redis").replace("2. Redis", "\n\n2. Redis").replace("THIS SOFT", "\n\nTHIS SOFT")
    found = FULL.find("BSD 2-Clause License\n\nCopyright (c) 2020, Somebody\n\n" + body)
    assert set(found) == {"bsd-2-clause"}


def test_another_version_or_variant_is_not_the_licence():
    assert FULL.find("Code here is licensed under the Apache License, Version 1.1, and that is that for now.") == {}
    assert FULL.find("It so happens that\nthis work is licensed under\nCC BY 3.0 since a year ago") == {}
    assert set(FULL.find("It so happens that this work is licensed\nunder CC BY-NC\n4.0 since a year ago")) == {"cc-by-nc-4.0"}


def test_prose_has_no_licence():
    assert SCANNER.scan("The license of a driver. All the rights of the reader are reserved to them.") == {}


def test_given_documents_agree_with_sql(spark):
    got = license_scan(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    cursor = db.execute(ORACLE["op10_license_scan"])
    names = [column[0] for column in cursor.description]
    want = rows_of(names, cursor.fetchall())
    assert len(want) > 20 and rows_of(got.columns, got.collect()) == want


def test_odd_rows(spark, odd, nothing):
    assert license_scan(odd).collect() == [] == license_scan(nothing).collect()
    extra = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (None, "all RIGHTS reserved")]
    docs = spark.createDataFrame(extra, "doc_id long, text string")
    found = sorted((str(r.doc_id), r.license, r.unit) for r in license_scan(docs).collect())
    assert found == [("1", "mit", "text"), ("1", "mit", "text"), ("None", "all-rights-reserved", "text")]
