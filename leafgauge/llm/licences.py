"""Licence scans with a positional index of rare words (operator 1), in DataFrame functions only.

Words are ranked by how few documents hold them. Every template's rarest words of its key phrase are looked up in the
texts, so a text's other words, and other licences in it, take nothing from a template. Postings that agree on one
relative position are a candidate place, which must then show the whole key phrase and enough of the template's other
words at their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, cut

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases and labels of the contract.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Fixed values: (label, passage, key phrase in it) of well-known licences and notices, sentence by sentence.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted free of charge"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", "merge publish distribute sublicense and or sell"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "this permission notice shall be included"),
    ("mit", "released under the mit license", "mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", "unless required by applicable law or agreed to in writing"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license", "either version 3 of the license"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license", "either version 2 of the license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl-3.0", "under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation", "must reproduce the above copyright notice"),
    ("bsd-3-clause", "may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote products derived from this software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", "copy of the mpl"),
    ("epl-2.0", "the accompanying materials are made available under the terms of the eclipse public license v 2 0", "eclipse public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "attribution sharealike"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "must be plainly marked as such"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "any person or organization obtaining a copy"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document", "copy and distribute verbatim or modified copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary", "copy modify publish use compile sell or distribute"),
)
#: Rarest key words of a template that must agree on a place; part of a template's words to be there.
AGREE, COVER = 2, 0.5


def _postings(templates):
    out = []
    for t, (label, passage, key) in enumerate(templates):
        words, must = passage.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(must)] == must)
        out += [(t, label, i, w, at <= i < at + len(must), len(words)) for i, w in enumerate(words)]
    return out


def scan(docs: DataFrame, base=BASE, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id_col, n_words, n_base, first_word, last_word, base_labels, labels, score), one for each row of docs.

    Texts are lower-cased A-Z; words are runs of letters and digits (and whatever is not ASCII). n_base counts the places
    where a base phrase's words stand consecutively, first_word and last_word are the least and greatest start (null:
    none). labels also has those of templates found: the key phrase stands at its place in the passage, with at least
    COVER of all the passage's words at theirs. score: 1 with a base label, else the largest part of a found template's
    words that stand at their places, else 0. Null and empty texts have no words. Repeated rows and null ids are rows like
    others. An empty table gives no rows. Word frequencies count all rows; they choose what is looked up first, never what
    is found. Other columns are not looked at.
    """
    spark = docs.sparkSession
    known = sorted({w for p, _ in base for w in p.split()} | {w for _, p, _ in templates for w in p.split()})
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), F.lit(WORD), 0)
    rows = docs.select(F.col(id_col).alias("id"), words.alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("p"), w.alias("w"))), lambda x: x["w"].isin(known))
    rows = rows.select("id", F.size("words").cast("bigint").alias("n_words"), hits.alias("hits"))
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))

    def starts(p):
        def at(x, i):
            ok = x["w"] == p[0]
            for j in range(1, len(p)):
                y = F.get("hits", i + j)
                ok = ok & F.coalesce((y["w"] == p[j]) & (y["p"] == x["p"] + j), F.lit(False))
            return F.when(ok, x["p"])

        return F.array_compact(F.transform("hits", at))

    places = [starts(phrase.split()).alias(label) for phrase, label in base]
    based = rows.select("row", "id", "n_words", *places)
    every = F.flatten(F.array(*(F.col(f"`{label}`") for _, label in base)))
    named = F.array_sort(F.array_compact(F.array(*(F.when(F.size(F.col(f"`{label}`")) > 0, F.lit(label)) for _, label in base))))
    based = based.select("row", "id", "n_words", every.alias("at"), named.alias("b"))

    # At most as many rows as there are licence words.
    often = {r["w"]: r["n"] for r in rows.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x["w"]))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    postings, rarest = _postings(templates), []
    for t in range(len(templates)):
        must = sorted((often.get(w, 0), w, i) for u, _, i, w, need, _ in postings if u == t and need)
        rarest += [(t, i, w, min(AGREE, len(must))) for _, w, i in must[:AGREE]]
    rare = F.broadcast(spark.createDataFrame(rarest, "t int, i int, w string, agree int"))  # AGREE rows for each template
    whole = F.broadcast(spark.createDataFrame(postings, "t int, label string, i int, w string, must boolean, n int"))  # a row for each word of the templates
    look = sorted({w for _, _, w, _ in rarest})
    looked = rows.select("row", F.explode(F.filter("hits", lambda x: x["w"].isin(look))).alias("x")).select("row", "x.p", "x.w")
    spots = looked.join(rare, "w").groupBy("row", "t", (F.col("p") - F.col("i")).alias("d")).agg(F.count("*").alias("c"), F.max("agree").alias("agree")).where("c >= agree")
    there = rows.select("row", "hits")
    seen = spots.select("row", "t", "d").join(there, "row").join(whole, "t").withColumn("ok", F.array_contains("hits", F.struct((F.col("d") + F.col("i")).alias("p"), F.col("w").alias("w"))))
    seen = seen.groupBy("row", "t", "d", "label", "n").agg(F.bool_and(F.col("ok") | ~F.col("must")).alias("sure"), (F.count(F.when(F.col("ok"), 1)) / F.col("n")).alias("cover"))
    found = seen.where(F.col("sure") & (F.col("cover") >= COVER)).groupBy("row").agg(F.array_sort(F.collect_set("label")).alias("more"), F.max("cover").alias("cover"))

    out = based.join(found, "row", "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("at").cast("bigint").alias("n_base"),
        F.array_min("at").cast("bigint").alias("first_word"),
        F.array_max("at").cast("bigint").alias("last_word"),
        F.array_join("b", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("b", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("b") > 0, 1.0).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )
