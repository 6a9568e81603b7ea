"""The licence scan against a scorer in plain Python, and its calibration."""

import re

import duckdb

from flamequarry.llm import licenses as L

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal in the Software\nwithout restriction, including without limitation the rights to use, copy,\nmodify, merge, publish, distribute, sublicense, and sell copies of the Software"
ROWS = [(-1, f"head\n\n{MIT}\n\nlast words"), (-2, "SPDX-License-Identifier: MIT\nUnlicense\nAGPLv3\nthe driver license office is open"), (-3, None), (-4, ""), (-5, "GPL / MPL\nISC OR MIT"), (-6, "public domain dedication for all the people of the public domain")]


def plain(text):
    """(licences, unknown) of a text, one paragraph at a time."""
    m, found, unknown = L.model(), [], 0
    text = re.sub(L.WRAPPED.replace("(?dm)", "(?m)"), r"\1 ", text or "")
    for k, line in enumerate(text.split("\n")):
        f = L.features(line)
        p = L.probabilities(f, m["weights"], m["bias"], m["classes"])
        family, probability = max(p.items(), key=lambda x: x[1])
        if family == L.NONE:
            continue
        pairs = [x for x in f if " " in x or "=" in x]
        support = sum(x in m["templates"][family] for x in pairs) / len(pairs) if pairs else 0
        sure = probability >= m["threshold"], support >= L.CONFIRM
        if all(sure):
            found.append((k, family))
        elif any(sure):
            unknown += 1
    return found, unknown


def test_against_plain_python(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall() + ROWS
    got = {r.doc_id: ([(x.paragraph, x.family) for x in r.licences], r.n_unknown) for r in L.licensed(spark.createDataFrame(rows + rows[-3:], "doc_id long, text string")).collect()}
    assert got == {i: plain(t) for i, t in rows}
    assert got[-1] == ([(2, "mit")], 0) and got[-2][0] == [(0, "mit"), (1, "public-domain"), (2, "agpl")] and got[-3] == got[-4] == ([], 0)


def test_calibration():
    assert L.calibrated([0.9, 0.2, 0.0]) == 0.9 + 1e-6 and L.calibrated([0.9] + [0.2] * 199) == 0.2 + 1e-6 and L.calibrated([]) == 1e-6
    fit, held = L.samples()
    assert not {x for _, x in fit} & {x for _, x in held}
    harder = L.fitted(fit, held + [(L.NONE, "Released under the MIT License.")] * 20)
    assert L.fitted(fit, held)["threshold"] < 0.5 < 0.9 < harder["threshold"]


def test_columns_of_these_names_are_kept(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.", "mine", 7, "r")], "doc_id long, text string, licences string, n_unknown int, _row string")
    r = L.licensed(df).first()
    assert r.licences == "mine" and r.n_unknown == 7 and r["_row"] == "r" and [x.family for x in r["_licences"]] == ["mit"] and r["_n_unknown"] == 0
