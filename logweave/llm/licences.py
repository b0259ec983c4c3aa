"""Licence scan: a trained paragraph classifier with template confirmation.

A text is read line by line, and where lines are short, as in a licence wrapped to a
width, each line also with the lines that follow it.  Sparse word uni- and bigram counts go through
a multinomial logistic regression whose classes are the licence families, an
unknown licence, and no licence.  It is trained on notices made from the family
names, on sentences of the licence texts, on made-up names and texts of other
licences for the unknown class, and on a bounded sample of paragraphs for no
licence.  A probability threshold is calibrated on notices and
paragraphs that training did not see; below it a licence notice is of the unknown
class.  A family also has to be confirmed by a template: one of its name forms or a phrase
that its text has and no other family's, in order, or by CONTAINED of the window's four-word
sequences standing in the family's texts, one of them in no other's; otherwise it is unknown too.  In a window over
several lines the template has to begin in the first, so the line found is the one where it
begins.  Of the Creative Commons families the most special one confirmed is taken.

Lines of one family that follow each other are one notice, reported with its first and
last line; unknown lines amid a confirmed notice belong to it.

Everything runs as DataFrame operations and Spark's DataFrame machine learning
(JVM); no Python runs over rows.

Defined cases: a null text has no paragraphs; paragraphs without words are skipped;
repeated rows each report; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logweave.functions.materialize import computed
from logweave.llm.common import hash_sample, staged

#: Bound on the paragraphs that training and calibration read.
SAMPLE = 6_000
VOCABULARY = 8_000
MAX_WORDS = 40
#: Wrapped text: lines up to this many characters, so many of them read together, and the
#: most lines between two places of one notice.
LINE_CHARS, LINES, GAP = 120, 5, 5
#: Share of a window's four-word sequences in a family's texts that confirms it.
CONTAINED = 0.5
#: Probability that a window is of any licence from which on it is reported as unknown.
ANY_LICENCE = 0.8
#: Paragraphs whose words stand around notices in training.
PROSE = 500
#: Usual names of licence families.
FAMILIES = {
    "apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache 2 0 license",
                   "apache 2 0", "apache license v2 0"],
    "mit": ["mit license", "mit licence", "expat license"],
    "bsd": ["bsd license", "bsd 3 clause license", "bsd 2 clause license", "new bsd license",
            "bsd 3 clause", "bsd 2 clause"],
    "gpl-3.0": ["gnu general public license version 3", "gnu gpl version 3", "gplv3", "gpl 3 0",
                "gnu general public license v3", "gpl v3"],
    "gpl-2.0": ["gnu general public license version 2", "gnu gpl version 2", "gplv2", "gpl 2 0",
                "gnu general public license v2", "gpl v2"],
    "lgpl": ["gnu lesser general public license", "lgpl", "gnu library general public license"],
    "agpl": ["gnu affero general public license", "agpl"],
    "mpl-2.0": ["mozilla public license version 2 0", "mpl 2 0", "mozilla public license 2 0",
                "mozilla public license v 2 0", "mozilla public license v2 0"],
    "cc-by": ["cc by 4 0", "creative commons attribution 4 0", "creative commons attribution license",
              "cc by 3 0", "cc by 2 5", "cc by 2 0", "cc by 1 0", "creative commons attribution 3 0"],
    "cc-by-sa": ["cc by sa 4 0", "cc by sa 3 0", "creative commons attribution sharealike", "cc by sa",
                 "creative commons attribution share alike"],
    "cc-by-nc": ["cc by nc 4 0", "cc by nc", "creative commons attribution noncommercial",
                 "creative commons attribution non commercial"],
    "cc-by-nc-sa": ["cc by nc sa 4 0", "cc by nc sa", "creative commons attribution noncommercial sharealike",
                    "creative commons attribution non commercial share alike"],
    "cc-by-nd": ["cc by nd 4 0", "cc by nd", "creative commons attribution noderivatives",
                 "creative commons attribution noderivs", "creative commons attribution no derivatives"],
    "cc-by-nc-nd": ["cc by nc nd 4 0", "cc by nc nd", "creative commons attribution noncommercial noderivatives",
                    "creative commons attribution noncommercial noderivs",
                    "creative commons attribution non commercial no derivatives"],
    "cc0": ["cc0 1 0 universal", "cc0", "public domain dedication"],
    "isc": ["isc license", "isc licence"],
    "proprietary": ["all rights reserved"],
}
#: Sentences of the families' texts and notices.
TEXTS = {
    "apache-2.0": [
        "you may not use this file except in compliance with the license you may obtain a copy of the "
        "license at http www apache org licenses license 2 0",
        "unless required by applicable law or agreed to in writing software distributed under the "
        "license is distributed on an as is basis without warranties or conditions of any kind either "
        "express or implied see the license for the specific language governing permissions and "
        "limitations under the license",
        "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty "
        "free irrevocable copyright license to reproduce prepare derivative works of"],
    "mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions",
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software",
        "in no event shall the authors or copyright holders be liable for any claim damages or other "
        "liability whether in an action of contract tort or otherwise arising from out of or in "
        "connection with the software or the use or other dealings in the software",
        "spdx license identifier mit", "license mit"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions "
        "and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution",
        "neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission",
        "this software is provided by the copyright holders and contributors as is and any express or "
        "implied warranties including but not limited to the implied warranties of merchantability and "
        "fitness for a particular purpose are disclaimed"],
    "gpl-3.0": [
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation either version 3 of "
        "the license or at your option any later version",
        "the gnu general public license is a free copyleft license for software and other kinds of works",
        "under the terms of version 3 of the gnu general public license"],
    "gpl-2.0": [
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation either version 2 of "
        "the license or at your option any later version",
        "under the terms of the gnu general public license as published by the free software foundation "
        "version 2 of the license",
        "the licenses for most software are designed to take away your freedom to share and change it",
        "under the terms of version 2 of the gnu general public license"],
    "lgpl": [
        "this library is free software you can redistribute it and or modify it under the terms of the "
        "gnu lesser general public license as published by the free software foundation either version "
        "2 1 of the license or at your option any later version",
        "under the terms of the gnu lesser general public license as published by the free software "
        "foundation either version 3 of the license"],
    "agpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu affero general public license as published by the free software foundation either version "
        "3 of the license or at your option any later version",
        "the gnu affero general public license is a free copyleft license for software and other kinds "
        "of works specifically designed to ensure cooperation with the community"],
    "mpl-2.0": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of "
        "the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"],
    "cc-by": [f"to view a copy of this license visit creativecommons org licenses by {v} 0"
              for v in (4, 3, 2)],
    "cc-by-sa": [f"to view a copy of this license visit creativecommons org licenses by sa {v} 0"
                 for v in (4, 3)],
    **{f"cc-by-{x.replace(' ', '-')}": [
        f"to view a copy of this license visit creativecommons org licenses by {x} {v} 0" for v in (4, 3)]
        for x in ("nc", "nc sa", "nd", "nc nd")},
    "cc0": [
        "the person who associated a work with this deed has dedicated the work to the public domain by "
        "waiving all of his or her rights to the work worldwide under copyright law",
        "to the extent possible under law the author has waived all copyright and related or "
        "neighboring rights to this work", "creativecommons org publicdomain zero 1 0"],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice and this permission notice "
        "appear in all copies", "spdx license identifier isc", "license isc"],
    "proprietary": [
        "unauthorized copying of this file via any medium is strictly prohibited",
        "this source code is proprietary and confidential"],
}
#: Phrases of the above that confirm a family.
PHRASES = {
    "apache-2.0": ["apache org licenses license 2 0",
                   "agreed to in writing software distributed under the license",
                   "the license for the specific language governing permissions",
                   "royalty free irrevocable copyright license to reproduce prepare derivative works"],
    "mit": ["granted free of charge to any person obtaining a copy",
            "person obtaining a copy of this software", "associated documentation files the software",
            "to deal in the software without restriction",
            "persons to whom the software is furnished",
            "permission notice shall be included in all copies or substantial portions",
            "copies or substantial portions of the software",
            "in no event shall the authors or copyright holders be liable",
            "spdx license identifier mit", "license mit"],
    "bsd": ["redistribution and use in source and binary forms",
            "redistributions of source code must retain the above copyright notice",
            "redistributions in binary form must reproduce the above copyright notice",
            "to endorse or promote products derived from this software",
            "provided by the copyright holders and contributors as is"],
    "gpl-3.0": ["gnu general public license as published by the free software foundation either "
                "version 3", "gnu general public license is a free copyleft license",
                "version 3 of the gnu general public license"],
    "gpl-2.0": ["gnu general public license as published by the free software foundation either "
                "version 2", "gnu general public license as published by the free software foundation "
                "version 2", "licenses for most software are designed to take away",
                "version 2 of the gnu general public license"],
    "mpl-2.0": ["if a copy of the mpl was not distributed", "mozilla org mpl 2 0"],
    "cc-by": [f"creativecommons org licenses by {v}" for v in ("1 0", "2 0", "2 5", "3 0", "4 0")],
    "cc-by-sa": ["creativecommons org licenses by sa"],
    "cc-by-nc": [f"creativecommons org licenses by nc {v}" for v in (1, 2, 3, 4)],
    "cc-by-nc-sa": ["creativecommons org licenses by nc sa"],
    "cc-by-nd": ["creativecommons org licenses by nd"],
    "cc-by-nc-nd": ["creativecommons org licenses by nc nd"],
    "cc0": ["dedicated the work to the public domain by waiving all",
            "waived all copyright and related or neighboring rights",
            "creativecommons org publicdomain zero 1 0"],
    "isc": ["fee is hereby granted provided that the above copyright notice",
            "permission notice appear in all copies", "spdx license identifier isc", "license isc"],
    "proprietary": ["unauthorized copying of this file via any medium",
                    "proprietary and confidential"],
}
#: Sentences of licences outside the families.
OTHER_TEXTS = [
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
    "software and accompanying documentation covered by this license the software to use reproduce "
    "display distribute execute and transmit the software",
    "permission is hereby granted free of charge to any person obtaining a copy of the font software to "
    "use study copy merge embed modify redistribute and sell modified and unmodified copies of the font "
    "software",
    "permission is granted to anyone to use this software for any purpose including commercial "
    "applications and to alter it and redistribute it freely subject to the following restrictions",
    "this software is provided as is without any express or implied warranty in no event will the "
    "authors be held liable for any damages arising from the use of this software",
    "this is free and unencumbered software released into the public domain",
    "the contents of this file are subject to the terms of the common development and distribution "
    "license you may not use this file except in compliance with the license",
    "this program and the accompanying materials are made available under the terms of the eclipse "
    "public license"]
PATTERNS = ["{}", "licensed under {}", "licensed under the {}", "released under the {}",
            "released under {}", "this work is licensed under the {}",
            "this work is licensed under {}", "this software is distributed under the terms of the {}",
            "this file is part of a program available under the {}", "copyright holders license {}",
            "permission is granted under the {}", "spdx license identifier {}",
            "you may use this file under the terms of the {}", "published under the {}",
            "made available under the {}", "see the {} for details"]
MADE_UP = ["acme license", "example community license", "sunrise source license version 4",
           "contoso public terms", "open harvest licence", "blue river license 1 1",
           "research only license", "evaluation license agreement", "custom vendor license",
           "northwind shared source license", "end user license agreement", "data use licence"]
NONE, UNKNOWN = "none", "unknown"
#: The Creative Commons families, the more special ones first.
SPECIAL = ["cc-by-nc-sa", "cc-by-nc-nd", "cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by"]


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid (number of the row), doc_id, par (line number), w (words), n_first (words of the
    line): one row per line, and one for a short line with the short lines that follow it."""
    t = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                    F.split(F.col(text_col), "\n").alias("ls"))
    short = rf"[^\n]{{1,{LINE_CHARS}}}"
    lines = F.transform(F.sequence(F.lit(1), F.size("ls")), lambda i: F.struct(
        (i - 1).alias("par"), F.element_at("ls", i).alias("line"),
        F.when(F.length(F.element_at("ls", i)).between(1, LINE_CHARS)
               & F.length(F.get("ls", i)).between(1, LINE_CHARS),
               F.array_join(F.slice("ls", i, LINES), "\n")).alias("run")))
    e = t.select("rid", "doc_id", F.inline(lines))
    run = F.regexp_extract("run", rf"^{short}(?:\n{short}(?=\n|\z))*", 0)
    both = F.array(F.struct(tokens(F.col("line")).alias("w"), F.lit(False).alias("joined")),
                   F.struct(F.when(F.col("run").isNotNull(), F.slice(tokens(run), 1, MAX_WORDS)).alias("w"),
                            F.lit(True).alias("joined")))
    return e.select("rid", "doc_id", "par", F.size(tokens(F.col("line"))).alias("n_first"), F.inline(both)) \
        .filter((F.size("w") > 0) & (~F.col("joined") | (F.size("w") > F.col("n_first")) & (F.col("n_first") > 0)))


def _features(df: DataFrame, vocabulary: list[str]) -> DataFrame:
    from pyspark.ml.feature import CountVectorizerModel, NGram
    two = NGram(n=2, inputCol="w", outputCol="w2").transform(df)
    two = two.withColumn("grams", F.concat("w", "w2")).drop("w2")
    return CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features",
                                                binary=True).transform(two).drop("grams")


def _notices(spark: SparkSession, prose: list[list[str]]) -> DataFrame:
    """Training rows of the notices, plain and amid words of ``prose``."""
    rows = [(c, p.format(n).split(), i) for c, ns in [*FAMILIES.items(), (UNKNOWN, MADE_UP)]
            for n in ns for i, p in enumerate(PATTERNS)]
    rows += [(NONE, s.split(), i) for s in (
        "the driver must show a license at the desk", "human rights reserved a place in the debate",
        "the general public was invited", "he took poetic license with the version of the story",
        "public transport version 2 of the timetable", "the commons voted on the attribution of blame")
        for i in range(4)]
    rows += [(NONE, s.split(), i) for s in (
        "the visitors obtained permission to enter the castle free of charge",
        "any person obtaining a copy of the morning paper could read the notice",
        "the book was provided as is and the name of the author was not included in all copies",
        "the conditions of the road were met without warranty of a good journey",
        "the program of the foundation was published in source and translation")
        for i in range(4)]
    for c, texts in [*TEXTS.items(), (UNKNOWN, OTHER_TEXTS)]:
        held = [f" {x} " for x in FAMILIES.get(c, []) + PHRASES.get(c, [])]
        for text in texts:
            w = text.split()
            # The windows of the scan and wrapped lines that hold a template; for
            # calibration shorter lines and the text without its beginning.
            cuts = [(w[:MAX_WORDS], 0)]
            lines = [(w[i:i + n], fold) for n, fold in ((MAX_WORDS, 0), (12, 1), (10, 2), (9, 3))
                     for i in range(0, max(0, len(w) - 6), 3)]
            cuts += [(x, i) for x, i in lines if any(h in f" {' '.join(x)} " for h in held)]
            if len(w) > 8:
                cuts.append((w[2:MAX_WORDS], 3))
            rows += [(c, x, i) for x, i in cuts for _ in range(1 if i == 3 else 3)]
    for k, (c, w, i) in enumerate(rows[:] if prose else []):
        if c != NONE and len(w) <= MAX_WORDS - 4:
            room = (MAX_WORDS - len(w)) // 2
            before, after = prose[2 * k % len(prose)], prose[(2 * k + 1) % len(prose)]
            rows.append((c, before[:room] + w + after[:room], i))
    return spark.createDataFrame(rows, "class string, w array<string>, fold int")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE):
    """(model, vocabulary, classes, threshold).  Paragraphs for no licence come from
    at most ``sample`` documents."""
    from pyspark.ml.classification import LogisticRegression
    spark = docs.sparkSession
    some = hash_sample(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                       ["doc_id"], sample, total=docs.count(), order=["doc_id"])
    some = staged(some, "licence-docs")
    names = sorted({w for ns in FAMILIES.values() for n in ns for w in n.split()}
                   - {"0", "1", "2", "3", "4", "5", "v", "all", "by", "the", "new", "public", "general",
                      "library", "share", "alike", "non", "commercial"})
    phrases = "|".join(n for ns in PHRASES.values() for n in ns)
    plain = paragraphs(some).filter(~F.col("joined")).filter(~F.arrays_overlap("w", F.array(*map(F.lit, names)))) \
        .filter(~F.array_join("w", " ").rlike(rf"(^| )({phrases})( |$)")) \
        .select(F.slice("w", 1, MAX_WORDS).alias("w"), F.xxhash64("doc_id", "par").alias("o")) \
        .orderBy("o").limit(sample).select(F.lit(NONE).alias("class"), "w", "o")
    plain = staged(plain, "licence-plain")
    prose = [r.w for r in plain.orderBy("o").limit(PROSE).collect()]
    rows = staged(_notices(spark, prose).unionByName(plain.select("class", "w", F.pmod("o", F.lit(4)).cast("int")
                                                .alias("fold"))), "licence-train")
    grams = rows.select("class", F.explode(F.concat("w", F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))),
        lambda i: F.array_join(F.slice("w", i, 2), " ")))).alias("g"))
    top = grams.groupBy("g").agg(F.max(F.col("class") != NONE).alias("named"),
                                 F.count("*").alias("n"))
    vocabulary = [r.g for r in top.orderBy(F.desc("named"), F.desc("n"), "g")
                  .limit(VOCABULARY).collect()]
    classes = [NONE, UNKNOWN, *FAMILIES]
    index = F.element_at(F.create_map(*[x for i, c in enumerate(classes)
                                        for x in (F.lit(c), F.lit(float(i)))]), F.col("class"))
    data = _features(rows.withColumn("label", index), vocabulary)
    seen, unseen = data.filter("fold <> 3"), data.filter("fold = 3")
    model = LogisticRegression(family="multinomial", regParam=2e-3, elasticNetParam=0.2,
                               maxIter=60).fit(seen)
    return model, vocabulary, classes, _calibrate(model.transform(unseen))


def _calibrate(scored: DataFrame, precision: float = 0.99) -> float:
    """Smallest probability at which named families are right often enough; the
    lower bound if they are so at every probability seen."""
    from pyspark.ml.functions import vector_to_array
    p = F.array_max(vector_to_array("probability"))
    rows = scored.filter("prediction > 1").select(
        p.alias("p"), (F.col("label") == F.col("prediction")).alias("ok")) \
        .orderBy(F.desc("p")).collect()             # bounded by the training sample
    best, right = 0.5, 0
    for i, r in enumerate(rows, 1):
        right += r.ok
        if right / i >= precision:
            best = min(0.9, max(0.3, r.p)) if i < len(rows) else 0.3
    return best


def _four(w: Column) -> Column:
    """The four-word sequences of a window."""
    return F.when(F.size(w) > 3, F.transform(
        F.sequence(F.lit(1), F.size(w) - 3), lambda i: F.array_join(F.slice(w, i, 4), " "))) \
        .otherwise(F.array().cast("array<string>"))


def _sequences(family: str) -> set[str]:
    return {" ".join(x[i:i + 4]) for t in TEXTS.get(family, []) for x in [t.split()]
            for i in range(len(x) - 3)}


def _confirmed(family: str) -> Column:
    """Does a template of the family begin in the window's first line?"""
    joined = F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" "))
    head = F.length(F.array_join(F.slice("w", 1, F.col("n_first")), " ")) + 1
    found = F.lit(False)
    for n in FAMILIES[family] + PHRASES.get(family, []):
        found = found | F.when(F.col("joined"), F.instr(joined, f" {n} ").between(1, head)) \
            .otherwise(joined.contains(f" {n} "))
    texts = _sequences(family)
    alone = texts.difference(*[_sequences(f) for f in TEXTS if f != family])
    if alone:
        have, own = (F.split(F.lit("\n".join(sorted(x))), "\n") for x in (texts, alone))
        four = _four(F.col("w"))
        found = found | ((F.size(four) > 3) & F.array_contains(have, F.get(four, F.lit(0)))
                         & F.arrays_overlap(four, own)
                         & (F.size(F.array_intersect(four, have)) >= CONTAINED * F.size(four)))
    return F.coalesce(found, F.lit(False))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sample: int = SAMPLE) -> DataFrame:
    """doc_id, par (first line), last_line, family (or unknown), probability, confirmed: one row
    per licence notice."""
    from pyspark.ml.functions import vector_to_array
    pars = paragraphs(docs, id_col, text_col)
    model, vocabulary, classes, least = train(docs, id_col, text_col, sample)
    # A notice is short; a long paragraph is judged by its best window.
    step = MAX_WORDS // 2
    wins = pars.withColumn("w", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - step, F.lit(1)), F.lit(step)),
        lambda i: F.slice("w", i, MAX_WORDS)))) \
        .filter(~F.col("joined") | (F.size("w") > F.col("n_first")))
    scored = model.transform(_features(wins, vocabulary))
    prob = vector_to_array("probability")
    hit = scored.filter("prediction > 0").select(
        "rid", "doc_id", "par", "joined", "n_first", "w", F.col("prediction").cast("int").alias("c"),
        F.array_max(prob).alias("probability"), (1 - F.get(prob, F.lit(0))).alias("any"))
    guess = F.element_at(F.array(*map(F.lit, classes)), F.col("c") + 1)
    special = F.coalesce(*[F.when(_confirmed(f), F.lit(f)) for f in SPECIAL])
    plain = F.coalesce(*[F.when((F.col("guess") == f) & _confirmed(f), F.lit(f))
                         for f in FAMILIES if f not in SPECIAL], F.lit(None).cast("string"))
    hit = staged(hit.withColumn("guess", guess).filter(~F.col("joined") | (F.col("any") >= ANY_LICENCE)),
                 "licence-windows")
    hit = computed(hit, {"named": F.when(F.col("guess").isin(SPECIAL), special).otherwise(plain)})
    hit = hit.withColumn("sure", F.col("named").isNotNull() & (F.col("probability") >= least)) \
        .filter(F.col("sure") | ~F.col("joined") & (F.col("any") >= ANY_LICENCE))
    best = hit.groupBy("rid", "par", F.when(F.col("sure"), F.col("named")).otherwise(UNKNOWN).alias("family")).agg(
        F.first("doc_id").alias("doc_id"), F.max("probability").alias("probability"),
        F.max(F.col("named").isNotNull()).alias("confirmed"), F.max("joined").alias("joined"))
    return _notices_of(staged(best, "licence-hits"))


def _notices_of(best: DataFrame) -> DataFrame:
    """Joins the lines of a family that follow each other, and drops what is unknown in or
    beside a notice of a family.  The windows hold the lines found in one document."""
    known = best.filter(F.col("family") != UNKNOWN)
    by = Window.partitionBy("rid", "family").orderBy("par")
    opens = F.coalesce((F.col("par") - F.lag("par").over(by) > GAP).cast("int"), F.lit(1))
    notice = known.withColumn("opens", opens).withColumn("no", F.sum("opens").over(by)) \
        .groupBy("rid", "family", "no").agg(
            F.first("doc_id").alias("doc_id"), F.min("par").alias("par"),
            F.max(F.col("par") + F.col("joined").cast("int")).alias("last_line"),
            F.max("probability").alias("probability"), F.max("confirmed").alias("confirmed"))
    spans = notice.select(F.col("rid").alias("k"), F.col("par").alias("lo"), F.col("last_line").alias("hi"))
    unknown = best.filter(F.col("family") == UNKNOWN).join(
        spans, (F.col("rid") == F.col("k")) & F.col("par").between(F.col("lo") - GAP, F.col("hi") + GAP)
        & (F.col("lo") < F.col("hi")), "left_anti")
    own = best.filter(F.col("family") != UNKNOWN).select(F.col("rid").alias("k"), F.col("par").alias("p"))
    unknown = unknown.join(own, (F.col("rid") == F.col("k")) & (F.col("par") == F.col("p")), "left_anti")
    cols = ["doc_id", "par", "last_line", "family", "probability", "confirmed"]
    return notice.select(*cols).unionByName(unknown.withColumn("last_line", F.col("par")).select(*cols))
