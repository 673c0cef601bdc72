"""Licence recognition by sentences and rules, with built-in functions.

Sentences are normalised (lower case, letters and digits, single spaces) and
looked up among known licence sentences.  A known sentence may be wrapped over
lines, with comment marks, but does not reach over a paragraph's or another
sentence's end.  A document's known sentences, in order, are a sequence of
one-letter identifiers.  Licence rules are sequences
of those identifiers; they are tried in order, longer ones first, and each
match uses its sentences up.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Identifiers and normalised texts of common licence sentences.
SENTENCES = [
    ("A", "licensed under the apache license version 2 0"),
    ("B", "you may not use this file except in compliance with the license"),
    ("C", "you may obtain a copy of the license at"),
    ("D", "see the license for the specific language governing permissions and limitations under the license"),
    ("E", "released under the mit license"),
    ("F", "licensed under the mit license"),
    ("G", "the software is provided as is without warranty of any kind express or implied"),
    ("H", "this work is licensed under the gnu general public license version 3"),
    ("I", "this work is licensed under the gnu general public license version 2"),
    ("J", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
          "general public license as published by the free software foundation"),
    ("K", "either version 3 of the license or at your option any later version"),
    ("L", "either version 2 of the license or at your option any later version"),
    ("M", "licensed under cc by nc 4 0"),
    ("N", "licensed under cc by 4 0"),
    ("O", "licensed under cc by sa 4 0"),
    ("P", "all rights reserved"),
    ("Q", "redistribution and use in source and binary forms with or without modification are permitted provided "
          "that the following conditions are met"),
    ("R", "redistributions of source code must retain the above copyright notice this list of conditions and the "
          "following disclaimer"),
    ("S", "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
          "the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("T", "this is free and unencumbered software released into the public domain"),
    ("U", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("V", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
          "associated documentation files"),
]
# Licence names and their sentence sequences, in the order in which they are tried.
RULES = [
    ("Apache-2.0", "ABCD"), ("BSD-2-Clause", "PQRS"), ("BSD-2-Clause", "QRS"), ("GPL-3.0-or-later", "JK"),
    ("GPL-2.0-or-later", "JL"), ("MIT", "VG"), ("MIT", "EG"), ("MIT", "FG"), ("Apache-2.0", "A"), ("MIT", "E"),
    ("MIT", "F"), ("MIT", "V"), ("GPL-3.0", "H"), ("GPL-2.0", "I"), ("CC-BY-NC-4.0", "M"), ("CC-BY-4.0", "N"),
    ("CC-BY-SA-4.0", "O"), ("MPL-2.0", "U"), ("Unlicense", "T"), ("All-Rights-Reserved", "P"),
]
# Sentences of the standard notices and texts as they are worded, with the identifiers of what they say.
STANDARD = [
    ("A", "licensed under the apache license version 2 0 the license"),
    ("AB", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
           "with the license"),
    ("AB", "the asf licenses this file to you under the apache license version 2 0 the license you may not use this "
           "file except in compliance with the license"),
    ("C", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("C", "you may obtain a copy of the license at https www apache org licenses license 2 0"),
    ("F", "this project is licensed under the mit license"),
    ("F", "this project is licensed under the mit license see the license file for details"),
    ("F", "this project is licensed under the mit license see the license md file for details"),
    ("F", "this project is licensed under the mit license see the license md license md file for details"),
    ("V", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
          "documentation files the software to deal in the software without restriction including without limitation "
          "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
          "permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("G", "the software is provided as is without warranty of any kind express or implied including but not limited to "
          "the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("G", "the software is provided as is without warranty of any kind express or implied including but not limited to "
          "the warranties of merchantability fitness for a particular purpose and non infringement"),
    ("JK", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation either version 3 of the license or at your "
           "option any later version"),
    ("JL", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation either version 2 of the license or at your "
           "option any later version"),
    *((letter, f"this work is licensed under {article} creative commons {kind} 4 0 international license")
      for letter, kind in (("M", "attribution noncommercial"), ("N", "attribution"), ("O", "attribution sharealike"))
      for article in ("a", "the")),
    *(("W", f"neither the name of {holder} nor the names of its contributors may be used to endorse or promote products "
            "derived from this software without specific prior written permission")
      for holder in ("the copyright holder", "the copyright holders", "the university")),
]
# What the standard texts need before ``RULES``; two clauses of BSD's three are no BSD-2-Clause.
STANDARD_RULES = [("BSD-3-Clause", "PQRSW"), ("BSD-3-Clause", "QRSW")]
SPLIT = r"([.!?])[ \t\r\n]+|[\r\n]+"
# Ends that no known sentence reaches over: of a sentence, but not after a number or "v.", and of a paragraph (a line
# without a letter or digit follows).
HARD = r"(?<![0-9])(?<!\b[vV])([.!?])[ \t\r\n]+|\n[^\p{L}\p{N}]*\n"


def _known_pattern(normals: list[str]) -> str:
    """Any known sentence, longer ones first, from one end (\\u0001 or \\u0002)
    to another, over any of the second kind."""
    known = "|".join("[ \u0002]+".join(map(re.escape, n.split(" "))) for n in sorted(set(normals), key=len, reverse=True))
    return f"(?<=^|[\u0001\u0002]) ?(?:{known}) ?(?=[\u0001\u0002]|\\z)"


def licence_sentences(docs: DataFrame, sentences=(*SENTENCES, *STANDARD), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Known sentences of each text: ``doc_id``, ``content`` (a hash of the
    text), ``place``, ``sentence`` (one or more identifiers)."""
    text = F.translate(F.replace(F.col(text_col).cast("string"), F.lit("\r\n"), F.lit("\n")), "\r\u0001\u0002", "\n__")
    ended = F.regexp_replace(F.regexp_replace(text, HARD, "$1\u0001"), SPLIT, "$1\u0002")
    plain = F.regexp_replace(F.lower(ended), "[^\\p{L}\\p{N}\u0001\u0002]+", " ")
    parts = F.regexp_extract_all(plain, F.lit(_known_pattern([n for _, n in sentences])), F.lit(0))
    normal = F.trim(F.regexp_replace("part", "[ \u0002]+", " "))
    known = F.broadcast(docs.sparkSession.createDataFrame(list(sentences), "sentence string, normal string"))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("content"),
                        F.posexplode(parts).alias("place", "part"))
            .select("doc_id", "content", "place", normal.alias("normal")).join(known, "normal").drop("normal"))


def find_licences(docs: DataFrame, sentences=(*SENTENCES, *STANDARD), rules=(*STANDARD_RULES, *RULES),
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``licence``, ``n_matches`` for each licence of each text.

    Null and empty texts have none; a null id stays null; rows with equal id
    and text are one document; other columns are not read; an empty table gives
    an empty result.  Long texts are read
    whole, by patterns that keep no state for each character; a document's
    known sentences are one string of a letter each, bounded by its own text.
    """
    ids = (licence_sentences(docs, sentences, id_col, text_col).groupBy("doc_id", "content")
           .agg(F.array_sort(F.collect_set(F.struct("place", "sentence"))).alias("found")))
    left = F.array_join(F.col("found.sentence"), "")
    found = []
    names = list(dict.fromkeys(name for name, _ in rules))
    rows = ids.withColumn("s0", left)
    for i, (_, sequence) in enumerate(rules):  # a used-up match leaves a mark, so its neighbours don't join up
        rows = rows.withColumn(f"s{i + 1}", F.replace(F.col(f"s{i}"), F.lit(sequence), F.lit("-")))
        size = len(sequence) - 1
        count = (F.length(f"s{i}") - F.length(f"s{i + 1}")) / size if size else \
            F.length(f"s{i}") - F.length(F.replace(F.col(f"s{i}"), F.lit(sequence), F.lit("")))
        found.append(count.cast("long"))
    total = [F.struct(F.lit(name).alias("licence"), sum((c for c, (n, _) in zip(found, rules) if n == name), F.lit(0).cast("long")).alias("n_matches"))
             for name in names]
    return rows.select("doc_id", F.explode(F.array(*total)).alias("x")).select("doc_id", "x.*").filter("n_matches > 0")
