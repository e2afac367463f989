"""License scans: a trained paragraph classifier with template comparison.

The paragraphs of a text are its lines, and its blocks of several lines between blank ones: a notice may be wrapped. Every
line goes to a multinomial logistic regression over word 1-grams and 2-grams, a block of which no line is confirmed too; its sparse weights were trained on the templates below, thinned and mixed by a seeded rule, and on
a bounded sample of paragraphs of the corpus as the unknown class; a temperature fitted on texts kept aside calibrates
the probabilities. A predicted family counts only if enough of one of its templates' 2-grams stand in the paragraph.

Training runs in numpy on the driver on bounded samples; scanning is one projection of built-in functions, without
a shuffle.

Defined results: a NULL or empty text has no paragraphs and license `none`; a text in which nothing is confirmed is
`unknown` if a line has a licence word, else `none`; among
equally probable paragraphs the first counts; equal texts get equal results; repeated rows stay repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"
#: Wording of well-known licence notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
     "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation."),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission."),
)
#: Licence words: they tell `unknown` from `none`, and decide nothing else.
STEMS = ("licens", "copyright", "permission", "redistribut", "rights reserved", "public domain", "warrant")
#: Paragraphs of the corpus that the unknown class is trained on at most, and characters of each.
SAMPLE, SAMPLE_CHARS = 2_000, 600
#: Between blocks: one or more blank lines.
BLANK = r"\n\s*\n"
CLEAN = r"[^\p{L}\p{N}.+-]+"


@dataclass(frozen=True)
class Model:
    families: list[str]  # the unknown class is last
    weights: dict[str, list[float]]
    bias: list[float]
    least: float = 0.5
    similar: float = 0.6


def grams_of(paragraph: str) -> list[str]:
    """Distinct words and word pairs; the same rule as in `findings`."""
    import regex

    tokens = [t.strip(".+-") for t in regex.sub(CLEAN, " ", paragraph.lower()).split(" ")]
    tokens = [t for t in tokens if t]
    return sorted({*tokens, *(f"{a} {b}" for a, b in zip(tokens, tokens[1:]))})


def pairs(tokens: Column) -> Column:
    following = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    held = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.zip_with(held, following, lambda a, b: F.concat_ws(" ", a, b))


def tokens(paragraph: Column) -> Column:
    cut = F.split(F.regexp_replace(F.lower(paragraph), CLEAN, " "), " ")
    return F.filter(F.transform(cut, lambda t: F.btrim(t, F.lit(".+-"))), lambda t: t != "")


def train(others: list[str], rounds: int = 300, rate: float = 0.3, sparse: float = 2e-4, seed: int = 11) -> Model:
    """Proximal gradient descent (L1) on cross entropy, then a temperature chosen on every fifth text."""
    rng = np.random.default_rng(seed)
    families = sorted({f for f, _ in TEMPLATES}) + [UNKNOWN]
    pool = [o.split() for o in others if o.split()] or [["text"]]
    texts: list[tuple[str, int]] = []
    for family, text in TEMPLATES:
        words = text.split()
        for i in range(12):
            kept = [w for w in words if i == 0 or rng.random() > 0.04 * (i % 4)]
            extra = pool[rng.integers(len(pool))]
            cut = extra[: int(rng.integers(0, 12))] if i % 3 == 2 else []
            texts.append((" ".join([*cut, *kept]), families.index(family)))
        for _ in range(3):  # a few words of a notice are no notice
            at = int(rng.integers(0, len(words)))
            texts.append((" ".join([*pool[rng.integers(len(pool))][:20], *words[at : at + 2]]), len(families) - 1))
    texts += [(o, len(families) - 1) for o in others]
    names = sorted({g for _, text in TEMPLATES for g in grams_of(text)})
    place = {g: i for i, g in enumerate(names)}
    x = np.zeros((len(texts), len(names)), np.float32)
    for row, (text, _) in zip(x, texts):
        row[[place[g] for g in grams_of(text) if g in place]] = 1
    y = np.array([k for _, k in texts])
    aside = np.arange(len(y)) % 5 == 4
    counts = np.bincount(y[~aside], minlength=len(families))
    cost = (1 / np.maximum(counts, 1))[y[~aside]][:, None] / len(families)
    w, b = np.zeros((len(names), len(families)), np.float32), np.zeros(len(families), np.float32)
    truth = np.eye(len(families), dtype=np.float32)[y[~aside]]

    def soft(z):
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    for _ in range(rounds):
        off = (soft(x[~aside] @ w + b) - truth) * cost
        w -= rate * 20 * (x[~aside].T @ off)
        b -= rate * 20 * off.sum(0)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * sparse, 0)
    scores = x[aside] @ w + b
    heats = np.linspace(0.5, 4.0, 36)
    loss = [-np.log(soft(scores / h)[np.arange(aside.sum()), y[aside]] + 1e-12).mean() for h in heats]
    heat = float(heats[int(np.argmin(loss))])
    w, b = w / heat, b / heat
    return Model(families, {g: [round(float(v), 6) for v in w[i]] for g, i in place.items() if w[i].any()}, [round(float(v), 6) for v in b])


def similarity_of(paragraph: str, family: str) -> float:
    own = set(grams_of(paragraph))
    best = 0.0
    for name, text in TEMPLATES:
        if name == family:
            wanted = [g for g in grams_of(text) if " " in g]
            best = max(best, sum(g in own for g in wanted) / len(wanted))
    return best


def fit(docs: DataFrame) -> Model:
    """Train with at most SAMPLE paragraphs of the corpus, chosen by hash, that are like no template."""
    key = F.xxhash64(F.col("doc_id"), F.lit("paragraph"))
    chosen = (
        docs.where(F.col("text").isNotNull())
        .groupBy(F.pmod(key, F.lit(SAMPLE)).alias("b"))
        .agg(F.min_by("doc_id", F.struct(key, "doc_id")).alias("doc_id"))
    )
    ids = [r.doc_id for r in chosen.select("doc_id").collect() if r.doc_id is not None]
    line = F.element_at(F.split(F.substring("text", 1, 4 * SAMPLE_CHARS), "\n"), -1)
    rows = docs.where(F.col("doc_id").isin(ids)).select("doc_id", F.substring(line, 1, SAMPLE_CHARS).alias("p")).collect()
    sample = sorted({(r.doc_id, r.p) for r in rows if r.p})
    families = {f for f, _ in TEMPLATES}
    return train([p for _, p in sample if max(similarity_of(p, f) for f in families) < 0.3])


def quoted(texts: list[str]) -> str:
    """An SQL array of texts."""
    return "array(%s)" % ",".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in texts)


def findings(model: Model, text: Column) -> Column:
    """For each line: its block and place, whether it has a licence word, family, probability, likeness to a template and
    whether it is confirmed. A block of several lines, none of them confirmed, follows as one paragraph."""

    def marked(p):
        test = F.lit(False)
        for stem in STEMS:
            test = test | F.contains(F.lower(p), F.lit(stem))
        return test

    known = sorted(model.weights)
    row_of = lambda values: "array(%s)" % ",".join(f"{v!r}D" for v in values)
    table = F.expr(f"map_from_arrays({quoted(known)}, array({','.join(row_of(model.weights[g]) for g in known)}))")
    start = F.expr(row_of(model.bias))

    def scored(block, no, p, mark):
        # bound once as the element of a one-element array, so that nothing is computed twice
        def with_tokens(t):
            hits = F.array_sort(F.array_distinct(F.filter(F.concat(t, pairs(t)), lambda g: g.isin(*known))))
            logits = F.aggregate(hits, start, lambda acc, g: F.zip_with(acc, F.element_at(table, g), lambda a, b: a + b))
            return F.transform(F.array(logits), lambda z: decided(t, z))[0]

        def decided(t, z):
            top = F.array_max(z)
            total = F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - top))
            place = F.array_position(z, top).cast("int")
            family = F.element_at(F.expr(quoted(model.families)), place)
            found = F.struct(
                block.alias("block"),
                no.alias("no"),
                mark.alias("marked"),
                family.alias("family"),
                F.round(F.lit(1.0) / total, 6).alias("probability"),
                F.round(likeness(t, family), 6).alias("similarity"),
            )
            return F.transform(F.array(found), confirmed)[0]

        def confirmed(f):
            sure = (f["family"] != UNKNOWN) & (f["probability"] >= model.least) & (f["similarity"] >= model.similar)
            return f.withField("sure", sure)

        return F.transform(F.array(tokens(p)), with_tokens)[0]

    def of_block(p, block):
        lines = F.transform(F.split(p, "\n"), lambda line, no: scored(block, no, line, marked(line)))
        wrapped = F.contains(p, F.lit("\n"))

        def with_whole(found):
            whole = F.array(scored(block, F.lit(0), p, F.lit(False)))
            return F.when(wrapped & ~F.exists(found, lambda f: f["sure"]), F.concat(found, whole)).otherwise(found)

        return F.transform(F.array(lines), with_whole)[0]

    return F.flatten(F.transform(F.split(text, BLANK), of_block))


def likeness(t: Column, family: Column) -> Column:
    """The largest share of a template's word pairs that the paragraph has, over the templates of the family."""
    out = F.lit(0.0)
    for name in sorted({f for f, _ in TEMPLATES}):
        shares = []
        for other, text in TEMPLATES:
            if other == name:
                wanted = [g for g in grams_of(text) if " " in g]
                shares.append(F.size(F.array_intersect(pairs(t), F.expr(quoted(wanted)))) / F.lit(float(len(wanted))))
        out = F.when(family == name, F.greatest(*shares) if len(shares) > 1 else shares[0]).otherwise(out)
    return out


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_paragraphs, n_marked (lines with a licence word), n_confirmed, license, probability and similarity."""
    found = docs.select(
        "doc_id",
        F.coalesce(F.size(F.filter(F.split("text", "\n"), lambda p: p != "")), F.lit(0)).cast("long").alias("n_paragraphs"),
        F.coalesce(findings(model, F.col("text")), F.array()).alias("found"),
    )
    ranked = found.withColumn("sure", F.filter("found", lambda f: f["sure"])).withColumn(
        "best",
        F.array_max(F.transform("sure", lambda f: F.struct(f["probability"], -f["block"], -f["no"], f["family"], f["similarity"]))),
    )
    marked = F.filter("found", lambda f: f["marked"])
    return ranked.select(
        "doc_id",
        "n_paragraphs",
        F.size(marked).cast("long").alias("n_marked"),
        F.size("sure").cast("long").alias("n_confirmed"),
        F.when(F.size("sure") > 0, F.col("best")["family"])
        .when(F.size(marked) > 0, F.lit(UNKNOWN))
        .otherwise(F.lit("none"))
        .alias("license"),
        F.col("best")["probability"].alias("probability"),
        F.col("best")["similarity"].alias("similarity"),
    )
