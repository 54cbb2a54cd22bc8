"""Notice tables, overlapping notices and tag expressions of the licence scan."""

import random
import time

import pytest

from reelrank.llm import license

CASES = [
    ("SPDX-License-Identifier: MIT (see LICENSE)", "mit", 0.1),
    ("SPDX-License-Identifier: MIT/Apache-2.0", "apache-2.0,mit", 0.1),
    ("# License-Expression : GPL-2.0-only WITH Classpath-exception-2.0", "gpl-2.0-only", 0.35),
    ("SPDX-License-Identifier: (MIT (x", "unreadable", license.UNKNOWN),
    ("SPDX License Identifier, without a colon behind it", "", 0.0),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of", "mit", 0.1),
    ("Redistribution and use in source and binary forms, with or without", "bsd", 0.1),
    # the base label stays, its strictness does not
    ("under the GNU Lesser General Public License", "gpl,lgpl", 0.5),
    ("the Lesser General Public License and the General Public License", "gpl,lgpl", 0.7),
    ("Creative Commons Attribution-ShareAlike 4.0", "cc-by-sa", 0.5),
    ("This is free and unencumbered software released into the public domain.", "unlicense", 0.0),
    ("CC BY-NC", "cc-by,cc-by-nc", 0.9),
    ("All rights reserved. All Rights Reserved", "reserved", 1.0),
]


def test_findings(spark):
    rows = [(i, t) for i, (t, _, _) in enumerate(CASES)]
    out = {r["doc_id"]: r for r in license.scan_licenses(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, labels, score) in enumerate(CASES):
        assert (out[i]["labels"], out[i]["score"]) == (labels, pytest.approx(score)), text


def test_notice_table_is_a_parameter(spark):
    rows = [(1, "House Rules apply; MIT License"), (1, None), (None, "house rules")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = license.scan_licenses(docs, notices={"house rules": "house"}).collect()
    assert sorted((r["labels"], r["score"]) for r in out) == [
        ("", 0.0), ("house", license.UNKNOWN), ("house", license.UNKNOWN)]
    with pytest.raises(ValueError):
        license.scan_licenses(docs, notices={"House rules": "house"})


def test_longest_against_every_pair():
    r = random.Random(2)
    for _ in range(300):
        places = list({(a, a + r.randint(1, 6)) for a in (r.randint(0, 12) for _ in range(8))})
        places = [(a, b, f"{a}-{b}") for a, b in places]
        want = [p for p in places if not any(
            q != p and q[0] <= p[0] and p[1] <= q[1] for q in places)]
        assert license.longest(places) == sorted(want)


def test_time_grows_with_the_text():
    automata = license.automaton(license.MORE_PHRASES)

    def seconds(n):
        text = "All rights reserved; CC BY-NC SPDX-License-Identifier: MIT\n" * n
        t = time.perf_counter()
        assert license.scan(text, automata, license.MORE_PHRASES)[1] == 2 * n
        return time.perf_counter() - t

    small = min(seconds(2_000) for _ in range(3))
    assert seconds(40_000) < 60 * max(small, 0.005)
