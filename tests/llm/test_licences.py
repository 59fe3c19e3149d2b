import pytest
from pyspark.sql import functions as F

from lossline.llm import licences, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark.read.parquet(f"{SF}/documents.parquet").select("text"))


def test_equals_plain_scan(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scanner = licences.Scanner(model, 0.6)
    want = set()
    for r in docs.collect():
        for no, (begin, p) in enumerate(licences.paragraphs(r["text"])):
            assert r["text"][begin:begin + len(p)] == p
            family, probability, held = scanner.classify(p)
            if family != licences.UNKNOWN:
                want.add((r["doc_id"], no, begin, family, probability, held))
    got = {tuple(r)[:6] for r in licences.scan(docs, model).collect()}
    assert got == want and len(want) > 20


def test_notices_in_documents_are_found_and_clean_ones_left(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {}
    for r in queries.op1_licences(spark, SF).where("confirmed").collect():
        found.setdefault(r["doc_id"], set()).add(r["family"])
    named = {"MIT License": "MIT", "Apache License": "Apache-2.0", "General Public License": "GPL", "CC BY-NC": "CC-BY-NC"}
    for i, t in docs.items():
        families = {f for name, f in named.items() if name in t}
        assert found.get(i, set()) == families


def test_families_and_other_senses(model):
    s = licences.Scanner(model, 0.6)
    for family, notices in licences.NOTICES.items():
        for n in notices:
            got = s.classify(n)
            assert got[0] == family and got[2] == 1.0, (n, got)
            wrapped = "the and of thing\nother words " + n + " and more of them"
            assert s.classify(wrapped)[0] == family
    for text in ["He renewed his driving license in April and drove to the general store.", "The public works of the region are free and open.",
                 "and the of with for from", "Eauouon la de les aux"]:
        family, _, held = s.classify(text)
        assert family == licences.UNKNOWN or held < 0.6


def test_edges(spark, docs_of, edge_rows, model):
    rows = edge_rows + [(40, "Released under the MIT License.", "en", "a")] * 2 + [(None, "Licensed under the Apache License, Version 2.0.", "en", "a")]
    docs = docs_of(rows).withColumn("family", F.lit("clash"))
    got = licences.scan(docs, model).collect()
    assert sorted((str(r["doc_id"]), r["family"]) for r in got) == [("40", "MIT"), ("40", "MIT"), ("None", "Apache-2.0")]
    assert licences.scan(docs.limit(0), model).count() == 0
    assert licences.fit(docs.limit(0).select("text"))["labels"][0] == licences.UNKNOWN


# held-out notices, as files carry them: reworded, wrapped, with names and years
REAL = [
    ("SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: GPL-2.0-only", "GPL"),
    ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD"),
    ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.", "MIT"),
    ("Released under the GNU General Public License v2.", "GPL"),
    ("// Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)", "BSL-1.0"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "EPL"),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1, and copied below.", "OFL"),
    ("Licensed under the EUPL, Version 1.2 only (the \"Licence\").", "EUPL"),
    ("This software is provided 'as-is', without any express or implied warranty.", "Zlib"),
    ("This software is subject to the provisions of the Zope Public License, Version 2.1 (ZPL). A copy of the ZPL should accompany this distribution.", "ZPL"),
    ("Copyright (c) 2019 Jane Doe. Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.", "Apache-2.0"),
    ("This file is part of Foo. Foo is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "AGPL"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.", "MPL"),
    ("Except where otherwise noted, content on this site is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:", "BSD"),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice appear in all copies.", "ISC"),
]
# licences that are no family, and ordinary text
UNKNOWN = ["Licensed under the Sleepycat License.", "Released under the Ruby License.", "SPDX-License-Identifier: Frameworx-1.0",
           "This software is subject to the provisions of the Nokia Open Source License, Version 1.0a.",
           "Licensed under the Vovida Software License, Version 1.0.", "The license plate of the car was issued by the general store.",
           "The library is open to the public, and copies of the document are free."]


def test_held_out_notices_and_near_misses(model):
    s = licences.Scanner(model, 0.6)
    got = [(s.classify(t), want) for t, want in REAL]
    right = sum(g[0] == want for g, want in got)
    assert right >= len(REAL) - 1, [(w, g) for g, w in got if g[0] != w]
    confirmed = sum(g[0] == want and g[2] >= 0.6 for g, want in got)
    assert confirmed >= len(REAL) - 3, [(w, g) for g, w in got if g[2] < 0.6]
    wrong = [(t, s.classify(t)) for t in UNKNOWN]
    assert not [x for x in wrong if x[1][0] != licences.UNKNOWN and x[1][2] >= 0.6], wrong
    assert sum(x[1][0] == licences.UNKNOWN for x in wrong) >= len(UNKNOWN) - 1, wrong


def test_at_least_25_families():
    assert len(licences.NOTICES) >= 25 and set(licences.IDENTIFIERS) <= set(licences.NOTICES)


def test_known_lines_are_found(spark, model):
    """An independent check: lines that are exactly a known notice, found by plain string search."""
    lines = {n: f for f, ns in licences.NOTICES.items() for n in ns}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = set()
    for r in docs.collect():
        for line in (r["text"] or "").split("\n"):
            if line.strip() in lines:
                want.add((r["doc_id"], lines[line.strip()]))
    got = {(r["doc_id"], r["family"]) for r in licences.scan(docs, model).where("confirmed").collect()}
    assert want <= got
