"""License scans by sentence rules (operator 8), in DataFrame functions only.

A text is normalised (ASCII letters lowered, everything but letters, digits and inner dots a single
space) with a mark wherever a sentence may begin or end: at newlines and, before a blank, after
[.!?;:] and urls. A known licence sentence is found wherever it stands between two marks; marks
inside it (wrapped lines, "free software: you can", an url on a line of its own) count as blanks. Of
sentences that begin at one mark the longest is taken, and the search goes on behind it. The
identifiers found, in order, are matched against licence rules, which are sequences of identifiers:
every rule whose sequence stands in the text's sequence fits, unless a rule that supersedes it does. Where
the greater rule's sequence holds the lesser's, it does so at its own places alone (a second text of two
clauses beside one of three is found); a notice goes wherever the text it speaks of is found. Sentences
that are not known may stand between.

The SQL looks up single lines and parts of lines only; the two agree where no sentence is wrapped or
has a mark inside, as in the test tables.

Nulls count as empty texts, which have no licence. Each row is judged by itself, without a shuffle, so
repeated rows have equal results and null ids stay null; an empty table gives an empty table, texts of any
length are searched whole, and columns of any other name are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

# Sentences of public licences, as normalised text.
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2.0": "apache-notice",
    "licensed under the apache license version 2.0 the license": "apache-notice",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-see",
    "licensed under cc by nc 4.0": "cc-by-nc-4",
    "licensed under cc by 4.0": "cc-by-4",
    "licensed under cc by sa 4.0": "cc-by-sa-4",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc-by-4",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "cc-by-nc-4",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-warranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-warranty",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "mpl2-subject",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0": "mpl2-copy",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "lgpl21-later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "lgpl-warranty",
    "see the gnu lesser general public license for more details": "lgpl-see",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-later",
    "see the gnu affero general public license for more details": "agpl-see",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "spdx license identifier mit": "spdx-mit",
    "spdx license identifier apache 2.0": "spdx-apache-2",
    "spdx license identifier bsd 2 clause": "spdx-bsd-2",
    "spdx license identifier bsd 3 clause": "spdx-bsd-3",
    "spdx license identifier isc": "spdx-isc",
    "spdx license identifier mpl 2.0": "spdx-mpl-2",
    "spdx license identifier gpl 2.0 or later": "spdx-gpl-2-later",
    "spdx license identifier gpl 3.0 or later": "spdx-gpl-3-later",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights",
}

# Fixed values: (licence, identifiers in order, licences it supersedes); earlier rules come first in a result.
RULES = (
    ("Apache-2.0", ("apache-notice", "apache-compliance", "apache-copy", "apache-warranty", "apache-see"), ("Apache-2.0 (notice)",)),
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty"), ("MIT (notice)",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), ("BSD-2-Clause",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary"), ()),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-warranty", "gpl-see"), ("GPL-3.0 (notice)",)),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-warranty", "gpl-see"), ()),
    ("AGPL-3.0-or-later", ("agpl3-later", "gpl-warranty", "agpl-see"), ()),
    ("LGPL-2.1-or-later", ("lgpl21-later", "lgpl-warranty", "lgpl-see"), ()),
    ("LGPL-3.0-or-later", ("lgpl3-later", "lgpl-warranty", "lgpl-see"), ()),
    ("MPL-2.0", ("mpl2-subject", "mpl2-copy"), ()),
    ("ISC", ("isc-grant", "isc-warranty"), ()),
    ("SPDX MIT", ("spdx-mit",), ()),
    ("SPDX Apache-2.0", ("spdx-apache-2",), ()),
    ("SPDX BSD-2-Clause", ("spdx-bsd-2",), ()),
    ("SPDX BSD-3-Clause", ("spdx-bsd-3",), ()),
    ("SPDX ISC", ("spdx-isc",), ()),
    ("SPDX MPL-2.0", ("spdx-mpl-2",), ()),
    ("SPDX GPL-2.0-or-later", ("spdx-gpl-2-later",), ()),
    ("SPDX GPL-3.0-or-later", ("spdx-gpl-3-later",), ()),
    ("MIT (notice)", ("mit-notice",), ()),
    ("Apache-2.0 (notice)", ("apache-notice",), ()),
    ("GPL-3.0 (notice)", ("gpl3-notice",), ()),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",), ()),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",), ()),
    ("CC-BY-4.0", ("cc-by-4",), ()),
    ("Unlicense", ("unlicense",), ()),
    ("LicenseRef-All-Rights-Reserved", ("all-rights",), ()),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def marked(text: Column) -> Column:
    """The normalised text, a newline at every mark and at both ends."""
    cut = F.regexp_replace(F.translate(text, UPPER, LOWER), r"([.!?;:]|https?://\S+)[ \t\r]+", "$1\n")
    plain = F.regexp_replace(cut, r"[^a-z0-9.\n]+", " ")
    return F.regexp_replace(F.concat(F.lit("\n"), plain, F.lit("\n")), r"[ .]*\n[ .\n]*", "\n")


def pattern() -> str:
    """Any known sentence between two marks, longest first."""
    longest = sorted(SENTENCES, key=lambda s: (-len(s), s))
    return r"\n(" + "|".join(s.replace(".", r"\.").replace(" ", r"[ \n]") for s in longest) + r")(?=\n)"


def written(sequence: tuple) -> str:
    return "".join(f"|{x}|" for x in sequence)


def within(small: tuple, large: tuple) -> bool:
    return any(large[i : i + len(small)] == small for i in range(len(large)))


def scanned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, found (identifiers in order) and licences (in the rules' order) of every row."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    ids = F.transform(F.regexp_extract_all(marked(common.text_or_empty(text_column)), F.lit(pattern()), F.lit(1)), lambda s: F.element_at(known, F.translate(s, "\n", " ")))
    # every identifier between marks of its own, so that a sequence can be taken out without a trace
    path = F.array_join(F.transform("found", lambda x: F.concat(F.lit("|"), x, F.lit("|"))), "")
    rows = docs.select(F.col(id_column).alias("doc_id"), ids.alias("found")).withColumn("path", path)
    names = []
    for name, sequence, _ in RULES:
        above = [(other, held) for other, held, below in RULES if name in below]
        left = F.col("path")
        for _, held in above:
            if within(sequence, held):
                left = F.replace(left, F.lit(written(held)), F.lit(""))
        fit = F.contains(left, F.lit(written(sequence)))
        for _, held in above:
            if not within(sequence, held):
                fit = fit & ~F.contains("path", F.lit(written(held)))
        names.append(F.when(fit, name))
    return rows.select("doc_id", "found", F.filter(F.array(*names), lambda x: x.isNotNull()).alias("licences"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every document."""
    found = scanned(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("found").alias("n_sentences"), F.array_join("found", ",").alias("sentences"), F.array_join("licences", ",").alias("licences"))


def sql() -> str:
    case = "CASE s " + " ".join(f"WHEN '{s}' THEN '{i}'" for s, i in SENTENCES.items()) + " END"
    names = []
    for name, sequence, _ in RULES:
        above = [held for _, held, below in RULES if name in below]
        left = "path"
        for held in [h for h in above if within(sequence, h)]:
            left = f"replace({left}, '{written(held)}', '')"
        tests = [f"contains({left}, '{written(sequence)}')", *[f"NOT contains(path, '{written(h)}')" for h in above if not within(sequence, h)]]
        names.append("CASE WHEN " + " AND ".join(tests) + f" THEN '{name}' END")
    return f"""WITH cut AS (SELECT doc_id, list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?;:])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)),
  lambda s: regexp_replace(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9.]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g')) AS parts FROM documents),
ids AS (SELECT doc_id, list_filter(list_transform(parts, lambda s: {case}), lambda x: x IS NOT NULL) AS found FROM cut),
paths AS (SELECT doc_id, found, coalesce(array_to_string(list_transform(found, lambda x: '|' || x || '|'), ''), '') AS path FROM ids)
SELECT doc_id, CAST(len(found) AS INTEGER) AS n_sentences, coalesce(array_to_string(found, ','), '') AS sentences,
  coalesce(array_to_string(list_filter([{", ".join(names)}], lambda x: x IS NOT NULL), ','), '') AS licences FROM paths"""
