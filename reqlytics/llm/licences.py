"""License scan: a paragraph classifier over sparse word n-grams, with template comparison.

Every line of a text is a paragraph. Its words and word pairs are hashed to the features that licence notices
use; a multinomial logistic regression over them gives the probability of each licence family and of
"unknown", which is trained on paragraphs of the corpus and on sentences that only sound alike. The
probabilities are calibrated with a temperature on notices kept out of training. A predicted family is
confirmed where the paragraph holds enough of the word n-grams of one of the family's templates.

The model is fitted on a bounded sample: variants of the templates (words left out, prose around them) and at
most ``PROSE`` paragraphs from ``PROSE_DOCS`` documents. Scanning is a projection of DataFrame functions over
whole texts: no Python on the executors, no shuffle.

Results: null and empty texts have no paragraphs and no licence; repeated rows repeat their result; of equal
probabilities the first family in the list wins; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reqlytics.llm.common import by_hash, chosen, materialise

# Licence families and how their notices read.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or any later"
        " version.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
}
# Sentences with words of notices that name no licence of the list.
SOUND_ALIKES = [
    "A driving license is required to rent a car.",
    "Software licenses are the subject of chapter four.",
    "Licensed under the Harbour Public Notice, version 7.",
    "Released under the terms of the studio agreement.",
    "The new version was released under a different name.",
    "The MIT campus is in Cambridge.",
    "The Apache settled in the south, version of events two.",
    "General public opinion and public service, version 3 of the plan.",
    "Version 2.0 of the program was released in March.",
    "Permission is required to enter any of the files.",
    "The work is licensed by the city and the fee is paid.",
    "Free of charge to any person under ten.",
    "This work is part of a series of papers.",
    "Subject to the terms of the contract, source and form.",
    "The following conditions are met at most sites.",
    "Creative people and common attributes of international work.",
    "You may not use this file cabinet.",
    "All rights reserved by the owner of the house.",
]
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *TEMPLATES]
HASHES = 1 << 14
PROSE_DOCS, PROSE, VARIANTS = 400, 3000, 16
#: A feature that more of the sampled prose than this holds says nothing about licences.
COMMON = 0.01
CONFIRMED = 0.6
TEMPERATURES = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]


def words_of(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), "[^a-z0-9]+"), lambda w: w != "")


def gram_ids(words: Column) -> Column:
    """Hashes of the words and of all pairs of neighbours."""
    after = F.slice(words, 2, F.greatest(F.size(words), F.lit(1)))
    pairs = F.zip_with(words, after, lambda a, b: F.when(b.isNotNull(), F.pmod(F.xxhash64(a, b), F.lit(HASHES))))
    singles = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(HASHES)))
    return F.concat(singles, F.filter(pairs, lambda p: p.isNotNull()))


def number_list(values, kind: str) -> Column:
    """A constant array, written as one string that the optimizer reads once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


@dataclass
class Model:
    places: list[int]  # feature number of each hash, 0: none
    weights: list[float]  # feature by feature, one per family
    biases: list[float]
    templates: list[tuple[int, list[int]]]  # family, feature numbers
    temperature: float = 1.0

    def features(self, ids: Column) -> Column:
        """Feature numbers of hashes, each once."""
        places = number_list(self.places, "int")
        return F.array_distinct(
            F.filter(F.transform(ids, lambda i: F.element_at(places, (i + 1).cast("int"))), lambda p: p > 0)
        )

    def margins(self, features: Column) -> Column:
        k = len(FAMILIES)
        weights, biases = number_list(self.weights, "double"), number_list(self.biases, "double")
        return F.transform(
            F.sequence(F.lit(1), F.lit(k)),
            lambda c: F.aggregate(
                features, F.element_at(biases, c), lambda total, p: total + F.element_at(weights, (p - 1) * k + c)
            ),
        )

    def probabilities(self, margins: Column, temperature: float | None = None) -> Column:
        t = temperature or self.temperature
        return F.transform(margins, lambda m: 1 / F.aggregate(margins, F.lit(0.0), lambda s, o: s + F.exp((o - m) / t)))

    def likeness(self, family: Column, features: Column) -> Column:
        """Largest share of a template's features that the paragraph holds, over the family's templates."""
        rows = [{"family": f, "grams": g} for f, g in self.templates]
        listed = F.from_json(F.lit(json.dumps(rows)), "array<struct<family:int,grams:array<int>>>")
        own = F.filter(listed, lambda t: t["family"] == family)
        shares = F.transform(own, lambda t: F.size(F.array_intersect(features, t["grams"])) / F.size(t["grams"]))
        return F.coalesce(F.array_max(shares), F.lit(0.0))


def prose_sample(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """At most ``PROSE`` paragraphs of a bounded number of documents."""
    some = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    some = chosen(some.where("text IS NOT NULL"), "doc_id", PROSE_DOCS)
    lines = some.select(F.explode(F.split("text", "\n")).alias("line")).where("length(line) > 0")
    return lines.orderBy(by_hash(F.col("line")), "line").limit(PROSE)


def labelled(spark: SparkSession, prose: DataFrame) -> DataFrame:
    """Paragraphs with their family: variants of templates and sound-alikes, each among some prose."""
    rows = [(FAMILIES.index(f), n, t) for f, ts in TEMPLATES.items() for n, t in enumerate(ts)]
    rows += [(0, 100 + n, t) for n, t in enumerate(SOUND_ALIKES)]
    base = spark.createDataFrame(rows, "family int, number int, said string")
    variants = base.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    words = F.split("said", " ")
    # every variant but the first leaves out some words
    kept = F.filter(
        words,
        lambda w: (F.col("variant") == 0) | (F.pmod(F.xxhash64(w, F.col("variant"), F.col("number")), F.lit(9)) > 0),
    )
    size = max(1, prose.count())
    numbered = prose.select(
        F.pmod(F.xxhash64("line"), F.lit(size)).alias("slot"), F.slice(F.split("line", " "), 1, 12).alias("around")
    ).dropDuplicates(["slot"])
    slot = F.when(F.col("variant") % 2 == 1, F.pmod(F.xxhash64("number", "family", "variant"), F.lit(size)))
    changed = variants.select("family", "variant", kept.alias("kept"), slot.alias("slot"))
    around = F.coalesce("around", F.array())
    changed = changed.join(F.broadcast(numbered), "slot", "left")  # PROSE rows at most
    paragraph = F.when(F.col("variant") % 4 == 1, F.concat("kept", around)).otherwise(F.concat(around, "kept"))
    return changed.select("family", "variant", F.array_join(paragraph, " ").alias("said"))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    spark = docs.sparkSession
    prose = spark.createDataFrame(prose_sample(docs, doc_id, text).collect() or [("",)], "line string")
    rows = [(FAMILIES.index(f), t) for f, ts in TEMPLATES.items() for t in ts]
    notices = spark.createDataFrame(rows, "family int, said string")
    alikes = spark.createDataFrame([(0, t) for t in SOUND_ALIKES], "family int, said string")

    def ids(df: DataFrame, column: str) -> DataFrame:
        return df.withColumn("words", words_of(F.col(column))).withColumn("ids", F.array_distinct(gram_ids(F.col("words"))))

    used = ids(notices, "said").collect()
    # paragraphs of the sample that hold most of a notice are notices that nobody labelled
    plain = Model([0] * HASHES, [], [], [])
    numbers = {i: n for n, i in enumerate(sorted({i for r in used for i in r["ids"]}), start=1)}
    plain.places = [numbers.get(i, 0) for i in range(HASHES)]
    plain.templates = [(r["family"], sorted({numbers[i] for i in r["ids"]})) for r in used]
    seen = ids(prose, "line").withColumn("found", plain.features(F.col("ids")))
    most = F.greatest(*[plain.likeness(F.lit(f), F.col("found")) for f in range(1, len(FAMILIES))])
    seen = seen.where(most < CONFIRMED).select("line", "ids")
    n = max(1, seen.count())
    common = seen.select(F.explode("ids").alias("id")).groupBy("id").count().where(F.col("count") > COMMON * n)
    common = {r["id"] for r in common.collect()}  # HASHES rows at most
    active = sorted({i for r in [*used, *ids(alikes, "said").collect()] for i in r["ids"]} - common)
    numbers = {i: n for n, i in enumerate(active, start=1)}
    model = Model([numbers.get(i, 0) for i in range(HASHES)], [], [], [])
    model.templates = [(r["family"], sorted({numbers[i] for i in r["ids"] if i in numbers})) for r in used]

    examples = labelled(spark, prose).unionByName(
        seen.select(F.lit(0).alias("family"), F.pmod(F.xxhash64("line"), F.lit(VARIANTS)).cast("int").alias("variant"), F.col("line").alias("said"))
    )
    examples = ids(examples, "said").withColumn("features", model.features(F.col("ids"))).select("family", "variant", "features")
    width = F.sequence(F.lit(1), F.lit(max(1, len(active))))
    dense = F.transform(width, lambda i: F.array_contains("features", i).cast("double"))
    examples = examples.withColumn("vector", array_to_vector(dense)).withColumn("label", F.col("family").cast("double"))
    examples = materialise(examples, "notices")  # read again by every step of the regression
    held = F.col("variant") % 4 == 2
    regression = LogisticRegression(
        featuresCol="vector", labelCol="label", family="multinomial", regParam=0.002, maxIter=60, standardization=False
    )
    fitted = regression.fit(examples.where(~held))
    matrix = fitted.coefficientMatrix.toArray()
    known = range(matrix.shape[0])
    model.weights = [float(matrix[c, p]) if c in known else 0.0 for p in range(matrix.shape[1]) for c in range(len(FAMILIES))]
    model.biases = [float(fitted.interceptVector[c]) if c in known else -30.0 for c in range(len(FAMILIES))]
    kept_out = examples.where(held).select("family", model.margins(F.col("features")).alias("m"))
    loss = [
        F.avg(-F.log(F.greatest(F.element_at(model.probabilities(F.col("m"), t), F.col("family") + 1), F.lit(1e-12)))).alias(f"t{n}")
        for n, t in enumerate(TEMPERATURES)
    ]
    found = kept_out.agg(*loss).first()
    model.temperature = min(zip(found, TEMPERATURES))[1] if found[0] is not None else 1.0
    return model


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_paragraphs``, ``licences`` and ``unconfirmed`` (families, sorted, joined by
    commas) and ``notices`` (paragraph number from 1, family, probability, likeness, confirmed)."""
    lines = F.filter(F.split(F.coalesce(docs[f"`{text}`"], F.lit("")), "\n"), lambda p: F.length(p) > 0)
    found = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), lines.alias("lines"))
    found = found.withColumn("words", F.transform("lines", words_of))
    found = found.withColumn("features", F.transform("words", lambda w: model.features(gram_ids(w))))
    # paragraphs without any feature of a notice have the unknown class by the biases alone
    found = found.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_paragraphs"),
        F.filter(
            F.transform("features", lambda f, n: F.struct((n + 1).alias("place"), f.alias("f"))), lambda s: F.size(s["f"]) > 0
        ).alias("candidates"),
    )
    found = found.withColumn(
        "judged", F.transform("candidates", lambda s: F.struct(s["place"].alias("place"), s["f"].alias("f"), model.margins(s["f"]).alias("m")))
    )
    found = found.withColumn("judged", F.transform("judged", lambda s: F.struct(s["place"], s["f"], model.probabilities(s["m"]).alias("p"))))
    names = F.array(*[F.lit(f) for f in FAMILIES])

    def notice(s: Column) -> Column:
        family = (F.array_position(s["p"], F.array_max(s["p"])) - 1).cast("int")
        likeness = model.likeness(family, s["f"])
        return F.struct(
            s["place"].alias("paragraph"),
            F.element_at(names, family + 1).alias("family"),
            F.array_max(s["p"]).alias("probability"),
            likeness.alias("likeness"),
            (likeness >= CONFIRMED).alias("confirmed"),
        )

    found = found.withColumn("notices", F.filter(F.transform("judged", notice), lambda s: s["family"] != UNKNOWN))

    def families(confirmed: bool) -> Column:
        own = F.filter("notices", lambda s: s["confirmed"] == confirmed)
        return F.array_join(F.array_sort(F.array_distinct(F.transform(own, lambda s: s["family"]))), ",")

    return found.select("doc_id", "n_paragraphs", families(True).alias("licences"), families(False).alias("unconfirmed"), "notices")
