"""op10: held-out notices, sentences without a licence, awkward rows."""

import re as plain_re
import textwrap

import numpy as np
import pytest
import regex
from pyspark.ml.feature import HashingTF

from sitecast.llm import licenses as L


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


HELD_OUT = [("This project is distributed under the terms of the MIT License", "MIT"),
            ("code is licensed under the Apache License 2.0", "Apache-2.0"),
            ("The text is licensed under the GNU General Public License v3", "GPL"),
            ("text: licensed under CC BY-NC 4.0", "CC-BY-NC"),
            ("You may use it under the Mozilla Public License 2.0", "MPL")]
NONE = ["The licence fee rose again.", "Copyright law changed.", "They redistribute the land among farmers.",
        "no cue here", "A fishing license costs ten euros."]


def test_held_out_notices(spark, model):
    rows = [(i, t) for i, (t, _) in enumerate(HELD_OUT)]
    got = {r.doc_id: r for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    right = sum(got[i].family == f and got[i].confirmed for i, (_, f) in enumerate(HELD_OUT))
    assert right >= len(HELD_OUT) - 1


def test_no_licence(spark, model):
    rows = spark.createDataFrame(list(enumerate(NONE)), "doc_id long, text string")
    assert all(r.family == L.UNKNOWN and not r.confirmed for r in L.scan(rows, model).collect())


def test_awkward_rows(spark, model):
    line = "Released under the MIT License."
    rows = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, f"x\n{line}\n{line}", "a"), (3, f"x\n{line}\n{line}", "a"),
                                  (None, line, "a"), (4, "word " * 50_000 + "\n" + line, "a")],
                                 "doc_id long, text string, family string")
    got = sorted((r.doc_id or 0, r.paragraph, r.family) for r in L.scan(rows, model).collect())
    assert got == [(0, 0, "MIT"), (3, 1, "MIT"), (3, 1, "MIT"), (3, 2, "MIT"), (3, 2, "MIT"), (4, 1, "MIT")]


NO_CUE = [("Released under GPLv3.", "GPL"), ("LGPLv2.1 or later", "LGPL"), ("MPLv2", "MPL"),
          ("Distributed under Apache-2.0.", "Apache-2.0"), ("Available under BSD-3-Clause.", "BSD"),
          ("Distributed under the MIT terms.", "MIT"), ("Unlicense", "Unlicense"),
          ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR', "MIT"),
          # not among the templates in this form
          ("Provided under AGPLv3 only", "AGPL"), ("Code: BSD-2-Clause", "BSD"), ("Made available under Apache-2.0", "Apache-2.0")]
PROSE = ["Er kommt mit dem Bus und mit der Bahn.", "The band released a new record in May.",
         "An Apache pilot spoke at MIT.", "They live under the bridge."]


def test_notices_without_a_cue(spark, model):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NO_CUE)], "doc_id long, text string")
    got = {r.doc_id: r.family for r in L.scan(rows, model).collect()}
    assert got == {i: f for i, (_, f) in enumerate(NO_CUE)}
    assert L.scan(spark.createDataFrame(list(enumerate(PROSE)), "doc_id long, text string"), model).count() == 0


def test_notices_do_not_train_unknown(spark):
    rows = spark.createDataFrame([(1, "Distributed under Apache-2.0.\nThey live under the bridge.")], "doc_id long, text string")
    got = {r.text for r in L.training_rows(spark, rows, "doc_id", "text").where(f"family = '{L.UNKNOWN}'").collect()}
    assert "They live under the bridge." in got and "Distributed under Apache-2.0." not in got


def test_empty_table_trains_on_templates(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.scan(empty).count() == 0


def test_no_python_in_the_plan(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = L.scan(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


NOTICES = [("GPL", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your "
            "option) any later version."),
           ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution."),
           ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
            "Lesser General Public License as published by the Free Software Foundation; either version 3 of the License."),
           ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies.")]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_notices(spark, model, mark):
    rows = []
    for i, (_, notice) in enumerate(NOTICES):
        lines = "\n".join(mark + x for x in textwrap.wrap(notice, 78 - len(mark)))
        rows.append((i, f"A first line.\n\n{lines}\n\nAnother paragraph."))
    got = {r.doc_id: (r.family, r.confirmed) for r in
           L.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).where("line IS NULL").collect()}
    assert got == {i: (family, True) for i, (family, _) in enumerate(NOTICES)}


OTHERS = [("Eclipse Public License 2.0", "EPL"), ("Distributed under the Boost Software License, Version 1.0", "BSL"),
          ("This file is under the ISC License", "ISC"), ("Licensed under the EUPL 1.2", "EUPL"),
          ("Released under the zlib license", "Zlib")]


def test_families_beside_each_other(spark, model):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(OTHERS)], "doc_id long, text string")
    got = {r.doc_id: (r.family, r.confirmed) for r in L.scan(rows, model).collect()}
    assert got == {i: (f, True) for i, (_, f) in enumerate(OTHERS)}


def test_confirmed_only_by_the_nearest_family(spark, model):
    """A licence of no class is not confirmed as the family that it resembles."""
    rows = spark.createDataFrame([(1, "Open Software License 3.0"), (2, "Sun Public License 1.0")], "doc_id long, text string")
    for r in L.scan(rows, model).collect():
        assert r.family == L.UNKNOWN or not r.confirmed


def plain_grams(text):
    apart = regex.sub(r"(?<=\p{L}{2})(v?[0-9])", r" \1", text.lower())
    w = regex.findall(r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*", apart)
    return set(w) | {f"{a} {b}" for a, b in zip(w, w[1:])}


def plain_parts(text):
    """(paragraph, line, text) by going through the lines."""
    blocks = []
    for line in text.split("\n"):
        last = blocks[-1][-1] if blocks else None
        goes_on = last is not None and 50 <= len(last) <= 100 and last[-1] not in ".!?:;"
        if goes_on and regex.match(r"[ \t]*(?://|#|\*|--|;|%)?[ \t]*[\p{L}\"(]", line):
            blocks[-1].append(line)
        else:
            blocks.append([line])
    for k, b in enumerate(blocks):
        yield from ((k, i, x) for i, x in enumerate(b))
        if len(b) > 1:
            yield k, None, "\n".join(b)


def test_rows_equal_brute_force(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    wrapped = "\n".join(textwrap.wrap(NOTICES[0][1], 70))
    docs = docs.unionByName(spark.createDataFrame([(10**6, f"x\n{wrapped}\n\nMIT License")], "doc_id long, text string"))
    rows = docs.collect()
    every = sorted(set().union(*[plain_grams(x) for r in rows for *_, x in plain_parts(r.text or "")]))
    hashed = HashingTF(numFeatures=L.BUCKETS, inputCol="g", outputCol="f").transform(
        spark.createDataFrame([(g, [g]) for g in every], "name string, g array<string>"))
    place = {r.name: int(r.f.indices[0]) for r in hashed.select("name", "f").collect()}
    weights, bias = model.regression.coefficientMatrix.toArray(), model.regression.interceptVector.toArray()
    known = [(f, plain_grams(t)) for f, ts in L.TEMPLATES.items() for t in ts]
    want = set()
    for doc_id, text in rows:
        for k, i, part in plain_parts(text or ""):
            cue = bool(plain_re.search(L.CUE, part))
            if not (regex.search(r"[\p{L}\p{N}]", part) or cue):
                continue
            grams = plain_grams(part)
            at = sorted({place[g] for g in grams})
            z = weights[:, at].sum(axis=1) + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            best = max(range(len(p) - 1), key=lambda j: p[j])
            family = model.labels[best] if p[best] > model.thresholds[best] else L.UNKNOWN
            if family == L.UNKNOWN and not cue:
                continue
            own = max((len(g & grams) / len(g) for f, g in known if f == family), default=0.0)
            most = max(len(g & grams) / len(g) for _, g in known)
            want.add((doc_id, k, i, family, round(own, 3), own >= L.LEAST_SIMILARITY and most < own + L.MARGIN))
    got = L.scan(docs, model).collect()
    assert {(r.doc_id, r.paragraph, r.line, r.family, round(r.similarity, 3), r.confirmed) for r in got} == want
    assert len(got) == len(want) and any(x[2] is None for x in want)


def test_a_stray_notice_does_not_close_the_gate(spark):
    """Notices among the sample's paragraphs are kept out of unknown, and one that
    slips in does not lift every family's threshold."""
    rows = [(i, f"The weather on day {i} was fine in town {i % 17} and people went out.") for i in range(250)]
    rows += [(999, "Sous licence libre GPL troisième version")]
    fitted = L.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert max(fitted.thresholds) < 0.9
