"""License scans: a trained paragraph classifier, confirmed by comparison with templates. DataFrame functions only.

Paragraphs are lines; of a line of more than ``STRETCH`` words, stretches that share half with the next are judged, and the
best one counts, so prose around a notice doesn't dilute it. Features are word 1-grams and 2-grams of the lower-cased words
that hold at least one telling word (a word of the notices that is no common word), so a stretch without any telling word
has the score of an empty one, which is "unknown": such lines are dropped before any n-gram is made, without changing a
result. A softmax regression over these sparse features is trained on templates, on forms of short notices, on shortened
ones, on denied notices and on prose that only sounds alike. Its temperature is fitted on forms and prose that it was not
trained on, and a family counts when its calibrated probability reaches ``least``; else the line is unknown. A prediction is
confirmed when at least ``similar`` of the features occur in one template of the family.

The weights are a table of fixed size (the notices' n-grams), so they may be broadcast. Defined results: an empty table
gives an empty result; null and empty texts have no findings; repeated rows are scanned each; texts of any length are scanned
whole, a notice that is wrapped over several lines line by line; columns but doc_id and text are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices by licence family, as their licences word them.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This software is distributed under the terms of the Apache License.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Distributed under the GNU GPL, either version 2 of the License, or any later version.",
    ],
    "lgpl": [
        "This library is free software under the GNU Lesser General Public License.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, version 2.1.",
        "Licensed under the LGPL, version 2.1 or later.",
    ],
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "Released under the AGPL, version 3 or later.",
    ],
    "gfdl": [
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3.",
        "This page is available under the GNU Free Documentation License.",
        "Licensed under the GFDL.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "boost": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted to use, reproduce, display, distribute, execute, and transmit the Software under the Boost Software License.",
    ],
    "eclipse": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, version 1.0.",
        "Released under the EPL.",
    ],
    "creative_commons": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Except where otherwise noted, content is available under a Creative Commons Attribution-ShareAlike license.",
    ],
    "mozilla": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Licensed under the MPL 2.0.",
    ],
    "public_domain": [
        "This work has been dedicated to the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.",
    ],
}
# Forms of short notices; {} stands for a family's name. What is said with "not" is no notice.
NAMES = {
    "apache": ["Apache License", "Apache License 2.0"], "mit": ["MIT License", "MIT license terms"], "gpl": ["GNU General Public License", "GPL", "GPL v3", "GNU GPL version 2"],
    "lgpl": ["GNU Lesser General Public License", "LGPL"], "agpl": ["GNU Affero General Public License", "AGPL", "Affero GPL"], "gfdl": ["GNU Free Documentation License", "GFDL"],
    "bsd": ["BSD License", "BSD 2-Clause License"], "isc": ["ISC License"], "boost": ["Boost Software License"], "eclipse": ["Eclipse Public License", "EPL 2.0"],
    "creative_commons": ["Creative Commons Attribution License", "CC BY 4.0", "CC BY-SA 3.0"], "mozilla": ["Mozilla Public License", "MPL"], "public_domain": ["CC0 license"],
}
SAID = ["Licensed under the {}.", "Released under the {}.", "Distributed under the {}.", "This software is licensed under the {}.", "Published under the terms of the {}.", "The code is available under the {}."]
DENIED = ["This work is not licensed under the {}.", "It is not released under the {}.", "This was never distributed under the {}.", "The code is no longer available under the {}.", "Nothing here is licensed under the {}."]
UNKNOWN = [
    "All rights reserved.", "Copyright by the author.", "Only a licensed driver may use this road.", "The general public was asked to leave the building.",
    "Permission to enter was granted by the guard.", "The software version of this program is new.", "She released a new work under a different name.",
    "The free press published a source of the story.", "He is subject to the terms of the contract.", "Apache helicopters were distributed among the bases.",
    "Students of MIT released a paper on software.", "The GNU antelope is a common animal.", "A driving license is required in every state.",
    "The commons of the creative city are open to the public.", "Conditions of use are met in the source region.", "The library is open to any person.",
    "Our public domain of interest is the law of nature.", "The license plate of the car was lost.", "Please read the license terms of your vendor.",
    "Version 2.0 of the documentation is available.", "This file is a copy of the form.", "Attribution of the quote is noted otherwise.",
    "The ISC seminar starts at noon.", "He watched the EPL match.", "Mozilla hired a designer.", "Affero gave a talk about BSD and GPL history.", "The Apache people speak it.", "MPL is short for many things, as are CC and MIT.",
    "AGPL, LGPL and GFDL were in the crossword.", "The GNU project is old.", "We boost it.", "Eclipse glasses sold out.", "The eclipse was seen by the public in version two of the program.", "Boost your software sales with a license to print money.", "The foundation published a document on public permission.",
    "A licensed plumber may redistribute the water in both forms.", "The creative director granted her a fee.", "Materials were made available to the general public.", "See the license of each library before you copy it.",
]
COMMON = set(
    "a an and any are as at be by can code either except for free from general has have he in is it its may new not of on only or our other "
    "person she subject than that the their this to under use used was we where with without work you your mit v following file met never nothing longer no "
    "above all appear as authors both copies copy each page purpose see terms"
    .split()
)
SPLIT = r"[^a-z0-9]+"
# A notice that is denied: the denying words up to what they deny become one telling word.
DENY = r"\b(?:not|never|no longer|nothing|neither|nor)\b(?:\W+\w+){0,5}?\W+(?=(?:licensed|released|distributed|available|published|covered|provided|permitted|licensable)\b)"
DENIED_WORD = "denied"
STRETCH = 40  # words of a line that are judged together


def words_of(line: str) -> list[str]:
    return [w for w in re.split(SPLIT, re.sub(DENY, f" {DENIED_WORD} ", line.lower())) if w]


def grams(words: list[str], telling: set[str]) -> set[str]:
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]  # noqa: B905
    return {g for g in [*words, *pairs] if telling & set(g.split(" "))}


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def examples(forms: list[str], templates: bool = True) -> list[tuple[str, str]]:
    """(family, notice): the templates, and each family's names in the given forms; a denied notice is unknown."""
    out = [(f, t) for f, ts in TEMPLATES.items() for t in ts] if templates else []
    for family, names in NAMES.items():
        out += [(family if form in SAID else "unknown", form.format(name)) for name in names for form in forms]
    return out


class Model:
    """Trained on templates, on some forms of notices and on prose; the temperature is fitted on other forms, and prose left out."""

    def __init__(self, rounds: int = 600, penalty: float = 1e-4, seed: int = 5, forms: list[str] | None = None, other: list[str] | None = None):
        rng = np.random.default_rng(seed)
        self.families = [*TEMPLATES, "unknown"]
        trained = examples(SAID[:4] + DENIED[:3] if forms is None else forms) + [("unknown", t) for t in UNKNOWN[:-6]]
        held = examples(SAID[4:] + DENIED[3:] if other is None else other, templates=False) + [("unknown", t) for t in UNKNOWN[-6:]]
        names = {w for ns in NAMES.values() for n in ns for w in words_of(n)}
        self.telling = {w for w in names | {w for ts in TEMPLATES.values() for t in ts for w in words_of(t)} if w not in COMMON and not w.isdigit()} | {DENIED_WORD}
        vocabulary = sorted({g for _, t in trained for g in grams(words_of(t), self.telling)})
        self.place = {g: k for k, g in enumerate(vocabulary)}
        rows = [("unknown", [])] * 20
        for f, t in trained:
            w = words_of(t)
            rows.append((f, w))
            for _ in range(6):  # shortened forms; a denied one keeps its "not"
                keep = rng.random(len(w)) > 0.15
                rows.append((f, [x for x, k in zip(w, keep, strict=True) if k or x == DENIED_WORD]))

        def table(rows: list) -> tuple[np.ndarray, np.ndarray]:
            x = np.zeros((len(rows), len(vocabulary) + 1))
            for k, (_, w) in enumerate(rows):
                x[k, [self.place[g] for g in grams(w, self.telling) if g in self.place]] = 1
            x[:, -1] = 1
            return x, np.eye(len(self.families))[[self.families.index(f) for f, _ in rows]]

        x, y = table(rows)
        self.weights = np.zeros((x.shape[1], y.shape[1]))
        pace = np.zeros_like(self.weights)
        for _ in range(rounds):
            p = softmax(x @ self.weights)
            pace = 0.95 * pace - (x.T @ (p - y) / len(y) + penalty * self.weights)
            self.weights += pace
        x, y = table([(f, words_of(t)) for f, t in held])
        grid = np.geomspace(0.2, 3, 40)
        loss = [-np.log(np.maximum((softmax(x @ self.weights / t) * y).sum(1), 1e-12)).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])


def scan(docs: DataFrame, model: Model | None = None, least: float = 0.6, similar: float = 0.6) -> DataFrame:
    """A row per recognised paragraph: doc_id, paragraph, line, family, probability, similarity, confirmed."""
    model = model or Model()
    spark = docs.sparkSession
    families, k = model.families, len(model.families)
    quoted = lambda s: "'" + s + "'"  # noqa: E731  grams are letters, digits and spaces
    templates = [(f, t, grams(words_of(t), model.telling)) for f, t in examples(SAID[:1])]
    rows = ", ".join(
        f"({quoted(g)}, array({', '.join(f'{w:.6f}D' for w in model.weights[p])}), array({', '.join(str(int(g in s)) for _, _, s in templates)}))"
        for g, p in model.place.items()
    )
    weights = spark.sql(f"SELECT * FROM VALUES {rows} AS t(gram, w, in_template)")
    telling = F.array(*(F.lit(w) for w in sorted(model.telling)))
    lines = (
        docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("paragraph", "line"))
        .withColumn("words", F.split(F.regexp_replace(F.lower("line"), DENY, f" {DENIED_WORD} "), SPLIT))
        .where(F.arrays_overlap("words", telling))
        .withColumn("words", F.filter("words", lambda w: w != ""))
        .withColumn("row", F.monotonically_increasing_id())
    )
    # Stretches of a long line, each sharing half with the next; a line of at most ``STRETCH`` words is one.
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("words") - STRETCH) / (STRETCH // 2)).cast("int")))
    stretches = F.transform(starts, lambda k: F.slice("words", k * (STRETCH // 2) + 1, F.lit(STRETCH)))
    lines = lines.withColumn("stretch", F.explode(F.filter(stretches, lambda ws: F.arrays_overlap(ws, telling)))).drop("words").withColumnRenamed("stretch", "words").withColumn("part", F.monotonically_increasing_id())
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda n: F.concat_ws(" ", F.element_at("words", n), F.element_at("words", n + 1)))
    every = F.array_distinct(F.when(F.size("words") > 1, F.concat("words", pairs)).otherwise(F.col("words")))
    telling_grams = F.filter(every, lambda g: F.arrays_overlap(F.split(g, " "), telling))
    each = lines.withColumn("grams", telling_grams).withColumn("n_grams", F.size("grams")).withColumn("gram", F.explode("grams"))
    known = each.join(F.broadcast(weights), "gram", "left")  # a table of fixed size
    sums = [F.sum(F.coalesce(F.col("w")[j], F.lit(0.0))).alias(f"z{j}") for j in range(k)]
    hits = [F.sum(F.coalesce(F.col("in_template")[j], F.lit(0))).alias(f"t{j}") for j in range(len(templates))]
    scored = known.groupBy("part", "row", "doc_id", "paragraph").agg(F.max("line").alias("line"), F.max("n_grams").alias("n_grams"), *sums, *hits)
    logits = F.array(*((F.col(f"z{j}") + float(model.weights[-1, j])) / model.temperature for j in range(k)))
    scored = scored.withColumn("z", logits).withColumn("top", F.array_max("z")).withColumn("best", F.array_position("z", F.col("top")).cast("int"))
    scored = scored.withColumn("probability", 1 / F.aggregate("z", F.lit(0.0), lambda a, z: a + F.exp(z - F.col("top"))))
    family = F.element_at(F.array(*(F.lit(f) for f in families)), F.col("best"))
    # Of the line's features, the share in the best template of the family.
    best = F.coalesce(*(F.when(family == f, F.greatest(F.lit(0), *(F.col(f"t{j}") for j, (g, _, _) in enumerate(templates) if g == f))) for f in TEMPLATES), F.lit(0))
    found = scored.select("row", "doc_id", "paragraph", "line", family.alias("family"), "probability", (best / F.col("n_grams")).alias("similarity"))
    found = found.where((F.col("family") != "unknown") & (F.col("probability") >= least)).withColumn("confirmed", F.col("similarity") >= similar)
    kept = ("confirmed", "similarity", "probability", "family", "line")  # of a line's stretches the best
    out = found.groupBy("row", "doc_id", "paragraph").agg(F.max(F.struct(*kept)).alias("b"))
    return out.select("doc_id", "paragraph", *(F.col(f"b.{c}") for c in ("line", "family", "probability", "similarity", "confirmed")))
