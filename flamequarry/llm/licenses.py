"""Licence scan: a sparse word n-gram logistic regression over paragraphs, an unknown class, and templates. Native.

Paragraphs are lines, after wrapped ones are joined: a line of 40 to 100 characters that ends without . : ; ! or ? goes on in
the next one unless that is blank. Their words ([a-z0-9]+ of the A-Z lower-cased paragraph) and word pairs are looked up
among the model's features by a broadcast join (the features come from fixed samples, some hundreds whatever the corpus), and
their weights add up by paragraph. No feature consists of function words alone, so a paragraph without any of the model's
other words has the model's bias and is of no family: it is not taken apart. The model is a softmax regression over licence
families and "none", trained by proximal gradient steps (weights below the L1 threshold become zero). The unknown class is
calibrated on forms of notices and sentences that training does not see: ``threshold`` is the smallest
probability that at most ``FALSE`` of the held-out samples of "none" reach for a family. A prediction is
confirmed if at least ``confirm`` of the paragraph's word pairs stand in the predicted family's templates (a paragraph of one
word: if it is a name of the family). A paragraph that passes only one of threshold and confirmation is unknown.

Nulls, blank texts: no paragraphs. Repeated rows each get a result. Extra columns are kept; where one is called licences or
n_unknown, the new column has an underscore before its name.
"""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_name, lower_ascii, materialize, own_name, shared_folder, table

#: Licence families, their names and a passage of each text.
FAMILIES = {
    "mit": (["MIT License", "MIT licence", "Expat License", "terms of the MIT license"], "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and sell copies of the Software"),
    "apache": (["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0"], "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    "gpl": (["GNU General Public License, version 3", "GNU General Public License version 2", "GNU GPL v3", "GPL-3.0-or-later", "GNU General Public License", "GPLv3", "GPLv2"], "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    "lgpl": (["GNU Lesser General Public License", "GNU Lesser General Public License version 2.1", "GNU LGPL", "LGPL-2.1", "LGPLv3"], "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    "agpl": (["GNU Affero General Public License", "GNU Affero General Public License version 3", "GNU AGPL v3", "AGPL-3.0", "AGPLv3"], "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    "bsd": (["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "3-clause BSD license"], "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    "mpl": (["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"], "This Source Code Form is subject to the terms of the Mozilla Public License. If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org"),
    "isc": (["ISC License", "ISC licence"], "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    "cc-by-nc": (["CC BY-NC 4.0", "CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC"], "You may not use the material for commercial purposes. This work is licensed under a Creative Commons Attribution-NonCommercial license"),
    "cc-by": (["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike license"], "You must give appropriate credit, provide a link to the license, and indicate if changes were made. This work is licensed under a Creative Commons Attribution license"),
    "public-domain": (["CC0 1.0 Universal", "Unlicense", "public domain dedication"], "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
}
#: Identifiers of the families in SPDX notices.
SPDX = {"mit": ["MIT"], "apache": ["Apache-2.0"], "gpl": ["GPL-2.0-only", "GPL-3.0-only"], "lgpl": ["LGPL-2.1-only", "LGPL-3.0-only"], "agpl": ["AGPL-3.0-only"], "bsd": ["BSD-2-Clause", "BSD-3-Clause"], "mpl": ["MPL-2.0"], "isc": ["ISC"], "cc-by-nc": ["CC-BY-NC-4.0"], "cc-by": ["CC-BY-4.0"], "public-domain": ["CC0-1.0", "Unlicense"]}
#: Words that stand in any text: no feature is made of them alone.
FUNCTION = set("a an and any are as at be but by for from has have he her his if in is it its may no not of on or our she so such that the their them then there these they this to up was we were which will with you your".split())
NOTICES = ["{}", "{}.", "Released under the {}.", "Licensed under the {}.", "Licensed under {}.", "This work is licensed under the {}.", "This project is distributed under the {}.", "The code is available under the {}.", "See the {} for details.", "License: {}", "Published under the terms of the {}."]
#: Sentences of no family.
OTHERS = """the driver license office is open on monday|he lost his fishing license last year|a license fee is charged for each copy of the book
all rights reserved by the author and the publisher|the software may be used by any person in the office|copyright of the pictures belongs to the museum
this work was done in the summer of that year|see the report for details|the project is available to the public|released in the spring by the studio
the terms of the contract were not published|the general said that the public was free to go|version two of the plan was distributed to the staff
you may use the door on the left|this program is shown every evening|the foundation gave a grant to the library|permission to enter was granted by the guard
free of charge for children and students|the above notice was removed|it is sold without warranty of any kind|the source of the river was found in the hills
a commercial licence costs more|licensed premises must close at night|the university in massachusetts has an institute of technology|the tribe of the apache lived here
mozilla and gnu are names|the creative industries are common in the city|attribution of the painting is not certain|the domain of the king was large
published by the press of the city|under the terms agreed in writing the work ended in may|work in progress at the site|distributed to all houses in the street""".replace("\n", "|").split("|")  # fmt: skip
NONE = "none"
EPOCHS, RATE, L1 = 40, 0.3, 2e-4
CONFIRM, FALSE = 0.6, 0.01
SEPARATORS = "[^a-z0-9]+"
WRAPPED = r"(?dm)^([^\n]{39,99}[^\n.:;!?\x20\x09-\x0D])\n(?=[^\n]*[^\n\x20\x09-\x0D])"


def features(text: str) -> list[str]:
    """Words and word pairs; a paragraph of one word has =word in place of a pair."""
    import re

    w = [x for x in re.split(SEPARATORS, text.lower()) if x]
    pairs = [f"{a} {b}" for a, b in zip(w, w[1:])] if len(w) != 1 else [f"={w[0]}"]
    return [f for f in dict.fromkeys(w + pairs) if any(x not in FUNCTION for x in f.split())]


def samples() -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """(family, paragraph) to train on, and held out: notices of every name (every fourth form held out), windows of passages, and sentences of no family and their splices (every third sentence held out)."""
    out: tuple[list, list] = ([], [])
    for family, (names, passage) in FAMILIES.items():
        for k, notice in enumerate(NOTICES):
            out[k % 4 == 3].extend((family, notice.format(x)) for x in names)
        for x in SPDX[family]:
            out[0].append((family, f"SPDX-License-Identifier: {x}"))
        w = passage.split()
        out[0].extend((family, " ".join(w[i : i + size])) for size in (10, 16, len(w)) for i in range(0, max(1, len(w) - size + 1), 4))
    for side in (0, 1):
        pieces = [s.split() for i, s in enumerate(OTHERS) if (i % 3 == 2) == side]
        out[side].extend((NONE, " ".join(p)) for p in pieces)
        out[side].extend((NONE, " ".join(a[: len(a) // 2] + b[len(b) // 2 :])) for i, a in enumerate(pieces) for b in pieces[i % 3 :: 3])
    return out


def probabilities(ids, weights, bias, classes):
    s = [bias[k] + sum(weights[k].get(f, 0.0) for f in ids) for k in classes]
    top = max(s)
    e = [math.exp(x - top) for x in s]
    total = sum(e)
    return {k: x / total for k, x in zip(classes, e)}


def fitted(train: list[tuple[str, str]], held: list[tuple[str, str]]) -> dict:
    """classes, weights (by class and feature; zeros left out), bias, threshold, held_out (accuracy)."""
    fit, other = ([(y, features(x)) for y, x in part] for part in (train, held))
    classes = [*FAMILIES, NONE]
    weights, bias = {k: {} for k in classes}, dict.fromkeys(classes, 0.0)
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch / 10)
        for i in range(len(fit)):
            y, ids = fit[(i * 7919 + epoch) % len(fit)]
            for k, p in probabilities(ids, weights, bias, classes).items():
                g = rate * ((k == y) - p)
                if abs(g) < 1e-3:
                    continue
                bias[k] += 0.1 * g
                w = weights[k]
                for f in ids:
                    w[f] = w.get(f, 0.0) + g / math.sqrt(len(ids))
        for k, w in weights.items():
            cut = rate * L1 * len(fit)
            weights[k] = {f: math.copysign(abs(x) - cut, x) for f, x in w.items() if abs(x) > cut}
    bias[NONE] = max(bias.values()) + 0.5  # a paragraph without features is of no family
    guesses = [(y, max(p.items(), key=lambda kv: kv[1])) for y, ids in other for p in [probabilities(ids, weights, bias, classes)]]
    return {"classes": classes, "weights": weights, "bias": bias, "threshold": calibrated([p if k != NONE else 0.0 for y, (k, p) in guesses if y == NONE]), "held_out": sum(y == k for y, (k, _) in guesses) / len(guesses)}


def calibrated(passed: list[float]) -> float:
    """The smallest threshold that at most FALSE of the samples of no family reach; passed: their probabilities of a family."""
    allowed = int(FALSE * len(passed))
    highest = sorted(passed, reverse=True)[allowed] if len(passed) > allowed else 0.0
    return min(1.0, highest + 1e-6)


@lru_cache(maxsize=1)
def model() -> dict:
    """fitted() on the samples, and templates: word pairs and one-word names of each family."""
    templates = {k: {f for t in [passage, *(n.format(x) for x in names for n in NOTICES), *(f"SPDX-License-Identifier: {x}" for x in SPDX[k])] for f in features(t) if " " in f or "=" in f} for k, (names, passage) in FAMILIES.items()}
    return fitted(*samples()) | {"templates": templates}


def vocabulary(m: dict) -> list[str]:
    return sorted({f for w in m["weights"].values() for f in w} | {f for t in m["templates"].values() for f in t})


def feature_table(spark: SparkSession, m: dict) -> DataFrame:
    """term, w0.. (weight for each class), t0.. (1 for a word pair of the class' templates). The rows are constants of the plan."""
    rows = []
    for t in vocabulary(m):
        numbers = [m["weights"][k].get(t, 0.0) for k in m["classes"]] + [float(t in m["templates"].get(k, ())) for k in m["classes"]]
        rows.append(",".join([t, *(f"{x:.6g}" for x in numbers)]))
    n = len(m["classes"])
    cells = spark.range(1).select(F.explode(F.split(F.lit("|".join(rows)), r"\|")).alias("row")).select(F.split("row", ",").alias("c"))
    return cells.select(F.get("c", 0).alias("term"), *[F.get("c", i + 1).cast("double").alias(f"w{i}") for i in range(n)], *[F.get("c", n + i + 1).cast("double").alias(f"t{i}") for i in range(n)])


def row_key(docs: DataFrame):
    """128 bits of doc_id and text, nulls apart from empty texts."""
    return F.unhex(F.md5(F.concat_ws("\x01", F.col("doc_id").isNull().cast("string"), F.col("doc_id").cast("string"), F.col("text").isNull().cast("string"), F.col("text"))))


def scanned(docs: DataFrame) -> DataFrame:
    """docs: row, text, distinct. A row for each paragraph that the classifier or the templates put in a family: row, paragraph (number from 0), family, probability, support, confirmed."""
    m = model()
    classes = m["classes"]
    n = len(classes)
    words = sorted({x for f in vocabulary(m) for x in f.strip("=").split() if x not in FUNCTION})
    text = F.regexp_replace(F.coalesce("text", F.lit("")), WRAPPED, "$1 ")
    lines = docs.select("row", F.monotonically_increasing_id().alias("mid"), F.posexplode(F.split(text, "\n")).alias("paragraph", "line"))
    lines = lines.select("row", "mid", "paragraph", F.split(F.trim(F.regexp_replace(lower_ascii(F.col("line")), SEPARATORS, " ")), " ").alias("w"))
    lines = lines.where(F.arrays_overlap("w", F.array(*[F.lit(x) for x in words])))
    pairs = F.when(F.size("w") == 1, F.transform("w", lambda x: F.concat(F.lit("="), x))).otherwise(F.array_distinct(F.zip_with(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w")), lambda a, b: F.concat(a, F.lit(" "), b))))
    stop = F.array(*[F.lit(x) for x in sorted(FUNCTION)])
    lines = lines.select("row", "mid", "paragraph", F.array_distinct("w").alias("w"), pairs.alias("p"))
    # as in features(): pairs of function words alone do not count
    known = F.filter("p", lambda x: F.size(F.array_except(F.split(x, " "), stop)) > 0)
    lines = lines.select("row", "mid", "paragraph", "w", known.alias("p"))
    lines = lines.select("row", "mid", "paragraph", F.size("p").alias("pairs"), F.explode(F.concat("w", "p")).alias("term"))
    sums = [F.sum(f"{c}{i}").alias(f"{c}{i}") for c in "wt" for i in range(n)]
    folder = shared_folder(docs.sparkSession)
    table_ = F.broadcast(materialize(feature_table(docs.sparkSession, m), folder, "features"))  # as many rows as the samples have terms
    found = lines.join(table_, "term").groupBy("row", "mid", "paragraph", "pairs").agg(*sums)  # by physical row: repeated rows do not add up
    found = found.select("row", "paragraph", "pairs", *[(F.col(f"w{i}") + m["bias"][k]).alias(f"s{i}") for i, k in enumerate(classes)], *[f"t{i}" for i in range(n)])
    best = F.greatest(*[f"s{i}" for i in range(n)])
    pick = lambda f: F.coalesce(*[F.when(F.col(f"s{i}") == best, f(i)) for i in range(n)])
    total = sum((F.exp(F.col(f"s{i}") - best) for i in range(n)), F.lit(0.0))
    support = F.coalesce(F.try_divide(pick(lambda i: F.col(f"t{i}")), F.col("pairs")), F.lit(0.0))
    found = materialize(found.select("row", "paragraph", pick(lambda i: F.lit(classes[i])).alias("family"), (1 / total).alias("probability"), support.alias("support")).where(F.col("family") != NONE), folder, "scanned")
    return found.withColumn("confirmed", (F.col("probability") >= m["threshold"]) & (F.col("support") >= CONFIRM))


def licensed(docs: DataFrame) -> DataFrame:
    """docs plus licences: array of (paragraph, family) of the confirmed paragraphs, in order; n_unknown: paragraphs that the classifier put in a family but that stay unknown."""
    row, listed, unknown = fresh_name("row", docs.columns), own_name("licences", docs.columns), own_name("n_unknown", docs.columns)
    docs = docs.withColumn(row, row_key(docs))
    found = scanned(docs.select(F.col(row).alias("row"), "text"))
    likely = (F.col("support") >= CONFIRM) | (F.col("probability") >= model()["threshold"])
    # repeated rows share a key and have the same paragraphs: sets count them once
    by = found.where(likely).groupBy(F.col("row").alias(row)).agg(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.struct("paragraph", "family")))).alias(listed), F.count_distinct(F.when(~F.col("confirmed"), F.col("paragraph"))).alias(unknown))
    return docs.join(by, row, "left").drop(row).withColumn(listed, F.coalesce(listed, F.array().cast("array<struct<paragraph:int,family:string>>"))).withColumn(unknown, F.coalesce(unknown, F.lit(0).cast("long")))


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    rows = licensed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    written = F.array_join(F.transform("licences", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ",")
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("licences", lambda x: x["family"]))), ",")
    return rows.select("doc_id", F.size("licences").cast("long").alias("n_licences"), families.alias("families"), written.alias("paragraphs"), "n_unknown")
