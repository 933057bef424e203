"""License passages in texts, found by votes of word pairs on diagonals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mnemolake.llm.common import id_text

#: Everything that is no word character, A-Z being lower-cased later.
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False


#: Phrases and labels of the base, then public license notices.
TEMPLATES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "you may not use this file except in compliance with the license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("gpl", "this program is free software you can redistribute it and or modify it"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the software the software is provided as is without warranty of any "
        "kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose "
        "and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies the software is provided as is "
        "and the author disclaims all warranties with regard to this software including all implied warranties of merchantability "
        "and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any "
        "damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other "
        "tortious action arising out of or in connection with the use or performance of this software",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution",
    ),
)
#: Votes that fit the bits of one number.
_SECTION = 62


def _gram_table(spark: SparkSession, templates: tuple[Template, ...], k: int) -> DataFrame:
    """``template, label, base, grams, at`` and the words of every k-gram of every template."""
    rows = []
    for number, t in enumerate(templates):
        words = t.text.split()
        if len(words) < k:
            raise ValueError(f"a template needs {k} words: {t.text!r}")
        grams = len(words) - k + 1
        rows += [(number, t.label, t.base, grams, at, *words[at : at + k]) for at in range(grams)]
    gram = ", ".join(f"_t{j} string" for j in range(k))
    table = spark.createDataFrame(rows, f"_template int, _label string, _base boolean, _grams int, _at int, {gram}")
    return table.withColumn("_hash", F.xxhash64(*[f"_t{j}" for j in range(k)]))


def scan_licenses(
    docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, k: int = 2, gap: int = 2, coverage: float = 0.8,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """License labels of every document by diagonal voting.

    All rolling ``k``-word grams of all texts meet the positions of the same gram in the templates, by hash and
    then by the words themselves. A hit votes for its diagonal, document position minus template position; a
    diagonal with a vote of every gram is a verbatim place of the template. Diagonals at most ``gap`` apart are
    merged (words added or left out), and a merged span counts if ``coverage`` of the template's grams voted.

    Only hits and one line per document are shuffled, those of equal rows added up per task before; templates are a fixed table of the code and broadcast.
    One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``; the
    score is the largest coverage of any span. Templates may have any length. An empty table gives no rows. Null and empty texts have no words and score 0. Repeated rows get a
    row each. Windows go over one document's hits of one template.
    """
    spark = docs.sparkSession
    plain = id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    words = plain.select("doc_id", F.xxhash64("text").alias("text_hash"), F.array_remove(F.split("text", SEPARATOR), "").alias("w"))
    # An empty word in front of each text: its gram meets no template, and carries the line of the document.
    padded = words.withColumn("w", F.concat(F.array(F.lit("")), "w"))
    shifted = [F.col("w"), *[F.slice("w", F.lit(j + 1), F.size("w")) for j in range(1, k)]]
    zipped = F.arrays_zip(*[c.alias(f"w{j}") for j, c in enumerate(shifted)])
    grams = padded.select("doc_id", "text_hash", (F.size("w") - 1).cast("long").alias("n_words"), F.posexplode(zipped).alias("pos", "g"))
    own = [F.col(f"g.w{j}").alias(f"_w{j}") for j in range(k)]
    gram_hash = F.xxhash64(*[F.lower(f"_w{j}") for j in range(k)]).alias("_own_hash")
    rolling = grams.select("doc_id", "text_hash", "n_words", "pos", *own).select("*", gram_hash)
    table = F.broadcast(_gram_table(spark, templates, k))
    on = F.col("_own_hash") == F.col("_hash")
    for j in range(k):  # bytes are compared too: lower-casing turns a few other letters into ASCII
        on &= (F.lower(f"_w{j}") == F.col(f"_t{j}")) & (F.octet_length(f"_w{j}") == F.octet_length(f"_t{j}"))
    met = rolling.join(table, on, "left").where((F.col("pos") == 0) | F.col("_template").isNotNull())
    key = ["doc_id", "text_hash"]
    votes = met.select(
        *key, "n_words", "_template", "_label", "_base", "_grams", (F.col("pos") - 1 - F.col("_at")).alias("_diagonal"),
        F.expr(f"_at div {_SECTION}").alias("_section"), F.expr(f"shiftleft(1L, cast(_at % {_SECTION} AS int))").alias("_vote"),
        (F.col("pos") == 0).alias("_line"),
    )
    diagonals = votes.groupBy(*key, "_template", "_label", "_base", "_grams", "_diagonal", "_section").agg(
        F.bit_or("_vote").alias("_mask"), F.max("n_words").alias("n_words"), F.count_if("_line").alias("_rows")
    ).repartition(*key)  # equal rows' hits are one by now
    by = Window.partitionBy(*key, "_template").orderBy("_diagonal", "_section")
    whole = F.sum(F.bit_count("_mask")).over(Window.partitionBy(*key, "_template", "_diagonal")) == F.col("_grams")
    apart = F.coalesce(F.col("_diagonal") - F.lag("_diagonal").over(by) > gap, F.lit(True))
    spans = diagonals.withColumn("_whole", whole).withColumn("_apart", apart.cast("int"))
    spans = spans.withColumn("_span", F.sum("_apart").over(by)).groupBy(*key, "_template", "_label", "_base", "_grams", "_span", "_section").agg(
        F.bit_or("_mask").alias("_mask"), F.max("n_words").alias("n_words"), F.sum("_rows").alias("_rows"),
        F.count_if(F.col("_whole") & (F.col("_section") == 0)).alias("_places"),
        F.min(F.when(F.col("_whole"), F.col("_diagonal"))).alias("_first"), F.max(F.when(F.col("_whole"), F.col("_diagonal"))).alias("_last"),
    ).groupBy(*key, "_template", "_label", "_base", "_grams", "_span").agg(
        F.sum(F.bit_count("_mask")).alias("_votes"), F.max("n_words").alias("n_words"), F.sum("_rows").alias("_rows"), F.sum("_places").alias("_places"),
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
    )
    covered = F.coalesce(F.col("_votes") / F.col("_grams"), F.lit(0.0))
    is_base = F.coalesce(F.col("_base"), F.lit(False))
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("_label")))), ",")
    found = spans.groupBy(*key).agg(
        F.max("n_words").alias("n_words"),
        F.coalesce(F.sum(F.when(is_base, F.col("_places"))), F.lit(0)).alias("n_base"),
        F.min(F.when(is_base, F.col("_first"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("_last"))).cast("long").alias("last_word"),
        listed(is_base & (F.col("_places") > 0)).alias("base_labels"),
        listed((is_base & (F.col("_places") > 0)) | (~is_base & (covered >= coverage))).alias("labels"),
        F.max(covered).alias("score"), F.sum("_rows").cast("int").alias("_rows"),
    )
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows")))).drop("text_hash", "_rows", "_copy")
