"""License scans by a trained paragraph classifier, in DataFrame functions only.

A multinomial logistic regression over sparse word one- to three-grams tells licence families from an unknown
class. It is trained on the sentences below, and on shorter and framed forms of them made by rule; the threshold
under which a prediction counts as unknown lies between the held-out forms of known families and of the unknown
class. A prediction is confirmed when some template of its family has at least 0.8 of its five-word shingles
in the paragraph. Only paragraphs with one of the cue words, which every template has, are classified; the
weights travel as one literal, and scoring works on each row alone, without a shuffle.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE, CONFIRMED, GRAMS = 5, 0.8, (1, 2, 3)
UNKNOWN = "unknown"
#: Phrases by which the families are known.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX License Identifier Apache 2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX License Identifier MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX License Identifier GPL 3.0 or later",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX License Identifier CC BY NC 4.0",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following license conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
}
#: Sentences with cue words that belong to no family.
OTHERS = [
    "All rights reserved.", "Copyright by the authors.", "The driver showed a license at the border.", "Ask for permission before you copy this.",
    "Licensed under the terms of our customer agreement.", "This product comes without warranty.", "A fishing license is required by law in this state.",
    "Licensed practitioners work under supervision.", "The licence fee rises next year.", "Permission to land was granted to the pilot.",
    "Released under a private contract.", "This work is licensed to the university.", "Licensed under an unpublished internal license, version 7.",
    "The general public was licensed to enter.", "Software license sales grew by four percent.", "Version 3 of the licensed film was shown.",
    "Redistribution of wealth and licensed trade.", "The commons and their creative copyright disputes.",
]
CUES = ("licen", "copyright", "permission", "warrant", "redistribut")


def words(text):
    """Lower-cased words of a paragraph."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def grams(array, sizes=GRAMS):
    """Distinct runs of so many words, space-joined."""
    def of(n):
        return F.when(F.size(array) >= n, F.transform(F.sequence(F.lit(1), F.size(array) - n + 1), lambda i: F.array_join(F.slice(array, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of(n) for n in sizes]))


def shingles(array):
    """Five-word shingles; a shorter paragraph is one shingle."""
    return F.when(F.size(array) >= SHINGLE, grams(array, (SHINGLE,))).otherwise(F.array(F.array_join(array, " ")))


def has_cue(text):
    low = F.lower(text)
    out = low.contains(CUES[0])
    for cue in CUES[1:]:
        out = out | low.contains(cue)
    return out


def forms(sentence: str) -> list[str]:
    """A sentence and forms of it: framed, and without its first or last words."""
    own = sentence.split()
    out = [sentence, f"Note: {sentence}", f"{sentence} See the file for details.", f"This file is as follows. {sentence}"]
    for cut in (1, 2):
        if len(own) - cut >= 4:
            out += [" ".join(own[cut:]), " ".join(own[:-cut])]
    return out


@lru_cache(maxsize=4)
def trained(spark: SparkSession) -> tuple[list[str], dict[str, list[float]], list[float], float]:
    """Families, weights of each n-gram by family, intercepts, threshold."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer
    from pyspark.ml.functions import vector_to_array

    families = [*TEMPLATES, UNKNOWN]
    rows = [(float(k), f, i % 3 == 2) for k, name in enumerate(families) for s in TEMPLATES.get(name, OTHERS) for i, f in enumerate(forms(s))]
    data = spark.createDataFrame(rows, "label double, text string, held boolean").withColumn("grams", grams(words(F.col("text"))))
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=1 << 14).fit(data)
    table = counter.transform(data)
    model = LogisticRegression(family="multinomial", regParam=0.003, maxIter=60).fit(table.where("NOT held"))
    held = model.transform(table.where("held")).select("label", vector_to_array("probability").alias("p")).collect()
    last = len(families) - 1
    right = sorted(r["p"][int(r["label"])] for r in held if r["label"] != last)
    wrong = max((max(r["p"][:last]) for r in held if r["label"] == last), default=0.5)
    threshold = min(0.9, max(0.5, (wrong + right[len(right) // 20]) / 2))
    matrix = model.coefficientMatrix.toArray()
    return families, {g: [float(x) for x in matrix[:, j]] for j, g in enumerate(counter.vocabulary)}, [float(x) for x in model.interceptVector], float(threshold)


def scan(docs: DataFrame, text_col: str = "text", out: str = "licenses") -> DataFrame:
    """docs, all columns, and out: array<struct<paragraph, family, probability, similarity, confirmed>>.

    One entry for each line with a cue word, by place (from 0); the family is unknown below the threshold. A line
    that isn't confirmed by itself is judged again with the words after it, before it and on both sides, as many as
    the longest template has, up to lines without words: so templates wrapped over lines are confirmed at each of
    their lines with a cue word, if the line adds shingles to what its neighbours have. A null or empty text has
    none; a column named as `out` is replaced; repeated rows and null ids are rows like others; an empty table gives
    no rows.
    """
    families, weights, intercepts, threshold = trained(docs.sparkSession)
    table = F.from_json(F.lit(json.dumps(weights)), "map<string,array<double>>")
    start = F.array(*[F.lit(x) for x in intercepts])
    shapes = {f: [_plain_shingles(s) for s in TEMPLATES.get(f, [])] for f in families}
    templates = F.from_json(F.lit(json.dumps(shapes)), "map<string,array<array<string>>>")
    names = F.array(*[F.lit(f) for f in families])
    most = max(len(_plain_words(s)) for group in TEMPLATES.values() for s in group)

    def logits(own):
        return F.aggregate(grams(own), start, lambda acc, g: F.coalesce(F.zip_with(acc, F.try_element_at(table, g), lambda a, b: a + b), acc))

    def judged(own):
        def decided(e):
            best, total = F.array_max(e), F.aggregate(e, F.lit(0.0), lambda a, b: a + b)
            family = F.when(best / total >= threshold, F.element_at(names, F.array_position(e, best).cast("int"))).otherwise(UNKNOWN)
            return F.struct(family.alias("family"), (best / total).alias("probability"))

        return _let(F.transform(logits(own), lambda x: F.exp(F.greatest(F.least(x, F.lit(50.0)), F.lit(-50.0)))), decided)

    def held(template, own):
        return F.size(F.array_intersect(template, own))

    def entry(x, j, similar):
        like = F.coalesce(similar, F.lit(0.0))
        return F.struct(x["paragraph"].alias("paragraph"), j["family"].alias("family"), j["probability"].alias("probability"), like.alias("similarity"), ((j["family"] != UNKNOWN) & (like >= CONFIRMED)).alias("confirmed"))

    def alone(x):
        return _let(judged(x["own"]), lambda j: _let(shingles(x["own"]), lambda own: entry(x, j, F.array_max(F.transform(F.try_element_at(templates, j["family"]), lambda t: held(t, own) / F.size(t))))))

    def within(x, passage):
        """Judged as part of a passage; what neighbours hold without the line doesn't count as its own."""
        def similar(j, own):
            return F.array_max(F.transform(F.try_element_at(templates, j["family"]), lambda t: _let(held(t, own), lambda n: F.when(
                (n > held(t, shingles(x["before"]))) & (n > held(t, shingles(x["after"]))), n / F.size(t)).otherwise(0.0))))

        return _let(passage, lambda p: _let(judged(p), lambda j: _let(shingles(p), lambda own: entry(x, j, similar(j, own)))))

    def wrapped(x, first):
        passages = [F.concat(x["own"], x["after"]), F.concat(x["before"], x["own"]), F.concat(x["before"], x["own"], x["after"])]
        sure = F.filter(F.array(*[within(x, p) for p in passages]), lambda y: y["confirmed"])
        lonely = first["confirmed"] | (F.size(x["before"]) + F.size(x["after"]) == 0)
        return F.when(lonely, first).otherwise(F.coalesce(F.try_element_at(sure, F.lit(1)), first))

    def before(k):
        near = F.slice("__ends", F.greatest(k - most, F.lit(0)) + 1, F.least(k, F.lit(most)))
        run = _let(near, lambda n: F.flatten(F.slice(n, F.coalesce(F.array_max(F.transform(n, lambda w, i: F.when(F.size(w) == 0, i + 1))), F.lit(0)) + 1, F.size(n))))
        return _let(run, lambda r: F.slice(r, F.greatest(F.size(r) - most, F.lit(0)) + 1, F.lit(most)))

    def after(k):
        near = F.slice("__starts", k + 2, F.lit(most))
        run = _let(near, lambda n: F.flatten(F.slice(n, F.lit(1), F.coalesce(F.array_min(F.transform(n, lambda w, i: F.when(F.size(w) == 0, i))), F.size(n)))))
        return F.slice(run, F.lit(1), F.lit(most))

    found = docs.withColumn("__lines", F.when(has_cue(F.col(text_col)), F.transform(F.split(F.col(text_col), "\n"), lambda p: F.struct(has_cue(p).alias("cue"), words(p).alias("own")))))
    found = found.withColumn("__starts", F.transform("__lines", lambda x: F.slice(x["own"], F.lit(1), F.lit(most))))
    found = found.withColumn("__ends", F.transform("__lines", lambda x: F.slice(x["own"], F.greatest(F.size(x["own"]) - most, F.lit(0)) + 1, F.lit(most))))
    cued = F.filter(F.transform("__lines", lambda x, k: F.struct(k.alias("paragraph"), x["cue"].alias("cue"), x["own"].alias("own"))), lambda x: x["cue"])
    placed = F.transform(cued, lambda x: F.struct(x["paragraph"].alias("paragraph"), x["own"].alias("own"), before(x["paragraph"]).alias("before"), after(x["paragraph"]).alias("after")))
    final = F.transform(placed, lambda x: _let(alone(x), lambda first: wrapped(x, first)))
    none = F.array().cast("array<struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean>>")
    return found.withColumn(out, F.coalesce(final, none)).drop("__lines", "__starts", "__ends")


def _let(value, f):
    """f of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _plain_words(sentence: str) -> list[str]:
    return re.findall("[a-z0-9]+", sentence.lower())


def _plain_shingles(sentence: str) -> list[str]:
    own = _plain_words(sentence)
    return sorted({" ".join(own[i : i + SHINGLE]) for i in range(max(1, len(own) - SHINGLE + 1))})


def digest(docs: DataFrame) -> DataFrame:
    """For each document the confirmed families, and counts of its paragraphs with cue words."""
    found = scan(docs.select("doc_id", "text"))
    sure = F.filter("licenses", lambda x: x["confirmed"])
    return found.select("doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
                        F.size("licenses").cast("long").alias("n_paragraphs"), F.size(sure).cast("long").alias("n_confirmed"),
                        F.size(F.filter("licenses", lambda x: x["family"] == UNKNOWN)).cast("long").alias("n_unknown"))
