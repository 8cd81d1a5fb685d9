"""Licence scan by sentence rules: known sentences become identifiers, ordered rules read the identifier sequence.

A text is cut into sentences, each is normalised, and those in a fixed catalogue turn into identifiers. Licence rules
are sequences of identifiers, tried in order; what a rule has matched is used up, and its neighbours do not become
adjacent by it. Three cuts are read, since licence
text is often wrapped: at sentence ends with line breaks as blanks; at sentence ends and line breaks; and, as whole
licence files need it, at sentence ends, blank lines, list markers and copyright lines, with other line breaks as blanks.
All of it is DataFrame functions on one row at a time: no shuffle, no Python.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.urls import ascii_lower

# Known licence sentences, normalised (lower case, runs of other than a-z 0-9 as one blank), with their identifiers.
SENTENCES: dict[str, str] = {
    "released under the mit license": "MIT-NAMED",
    "licensed under the mit license": "MIT-NAMED",
    "this project is licensed under the mit license": "MIT-NAMED",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MIT-GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MIT-NOTICE",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MIT-WARRANTY",
    "licensed under the apache license version 2 0": "APACHE-2-NAMED",
    "licensed under the apache license version 2 0 the license": "APACHE-2-NAMED",
    "you may not use this file except in compliance with the license": "APACHE-2-COMPLY",
    "you may obtain a copy of the license at": "APACHE-2-COPY",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "APACHE-2-COPY",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "APACHE-2-AS-IS",
    "this work is licensed under the gnu general public license version 3": "GPL-3-NAMED",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL-3-LATER",
    "this program is free software": "GPL-FREE",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL-3-TERMS",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "GPL-TERMS",
    "either version 3 of the license or at your option any later version": "GPL-3-OR-LATER",
    "either version 2 of the license or at your option any later version": "GPL-2-OR-LATER",
    "licensed under cc by nc 4 0": "CC-BY-NC-4-NAMED",
    "licensed under cc by 4 0": "CC-BY-4-NAMED",
    "licensed under cc by sa 4 0": "CC-BY-SA-4-NAMED",
    "this work is licensed under a creative commons attribution 4 0 international license": "CC-BY-4-NAMED",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "CC-BY-NC-4-NAMED",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSD-GRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSD-SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSD-BINARY",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD-ENDORSE",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL-2-NAMED",
    "this source code form is subject to the terms of the mozilla public license v": "MPL-2-NAMED",
    "this source code form is subject to the terms of the mozilla public license version 2 0": "MPL-2-NAMED",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "MPL-2-COPY",
    "this library is free software": "LGPL-FREE",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "LGPL-TERMS",
    "either version 2 1 of the license or at your option any later version": "GPL-2-1-OR-LATER",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "AGPL-TERMS",
    "licensed under the gnu lesser general public license version 3": "LGPL-3-NAMED",
    "licensed under the gnu affero general public license version 3": "AGPL-3-NAMED",
    "licensed under the gnu general public license version 2": "GPL-2-NAMED",
    "licensed under the gnu general public license version 3": "GPL-3-NAMED",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC-GRANT",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0BSD-GRANT",
    "licensed under the isc license": "ISC-NAMED",
    "boost software license version 1 0": "BSL-TITLE",
    "distributed under the boost software license version 1 0": "BSL-NAMED",
    "this is free and unencumbered software released into the public domain": "UNLICENSE",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "CC0-WAIVED",
    "licensed under cc0 1 0": "CC0-NAMED",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "CC-BY-SA-4-NAMED",
    "licensed under cc by nd 4 0": "CC-BY-ND-4-NAMED",
    "licensed under cc by nc sa 4 0": "CC-BY-NC-SA-4-NAMED",
    "licensed under cc by nc nd 4 0": "CC-BY-NC-ND-4-NAMED",
    "this software is provided as is without any express or implied warranty": "ZLIB-AS-IS",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZLIB-GRANT",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0": "EPL-2-NAMED",
    "licensed under the bsd 3 clause license": "BSD-3-NAMED",
    "licensed under the bsd 2 clause license": "BSD-2-NAMED",
    "all rights reserved": "RESERVED",
    "apache license version 2 0": "APACHE-2-TITLE",
    "apache license version 2 0 january 2004": "APACHE-2-TITLE",
    "apache license version 2 0 january 2004 http www apache org licenses": "APACHE-2-TITLE",
    "bsd 2 clause license": "BSD-2-TITLE",
    "bsd 3 clause license": "BSD-3-TITLE",
    "eclipse public license v 2 0": "EPL-2-TITLE",
    "gnu affero general public license version 3": "AGPL-3-TITLE",
    "gnu affero general public license version 3 19 november 2007": "AGPL-3-TITLE",
    "gnu general public license version 2": "GPL-2-TITLE",
    "gnu general public license version 2 june 1991": "GPL-2-TITLE",
    "gnu general public license version 3": "GPL-3-TITLE",
    "gnu general public license version 3 29 june 2007": "GPL-3-TITLE",
    "gnu lesser general public license version 2 1": "LGPL-2-1-TITLE",
    "gnu lesser general public license version 2 1 february 1999": "LGPL-2-1-TITLE",
    "gnu lesser general public license version 3": "LGPL-3-TITLE",
    "gnu lesser general public license version 3 29 june 2007": "LGPL-3-TITLE",
    "mozilla public license version 2 0": "MPL-2-TITLE",
}
# Licence rules in the order in which they are tried, the more specific ones first.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("BSD-3-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE")),
    ("BSD-2-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY")),
    ("MIT", ("MIT-GRANT", "MIT-NOTICE", "MIT-WARRANTY")),
    ("MIT", ("MIT-GRANT", "MIT-NOTICE")),
    ("MIT", ("MIT-NAMED",)),
    ("Apache-2.0", ("APACHE-2-NAMED", "APACHE-2-COMPLY", "APACHE-2-COPY", "APACHE-2-AS-IS")),
    ("Apache-2.0", ("APACHE-2-NAMED", "APACHE-2-COMPLY")),
    ("Apache-2.0", ("APACHE-2-NAMED",)),
    ("GPL-3.0-or-later", ("GPL-3-LATER",)),
    ("GPL-3.0-or-later", ("GPL-FREE", "GPL-3-TERMS")),
    ("GPL-3.0-or-later", ("GPL-FREE", "GPL-TERMS", "GPL-3-OR-LATER")),
    ("GPL-2.0-or-later", ("GPL-FREE", "GPL-TERMS", "GPL-2-OR-LATER")),
    ("LGPL-2.1-or-later", ("LGPL-FREE", "LGPL-TERMS", "GPL-2-1-OR-LATER")),
    ("LGPL-3.0-or-later", ("LGPL-FREE", "LGPL-TERMS", "GPL-3-OR-LATER")),
    ("AGPL-3.0-or-later", ("GPL-FREE", "AGPL-TERMS", "GPL-3-OR-LATER")),
    ("GPL-3.0-only", ("GPL-3-NAMED",)),
    ("GPL-2.0-only", ("GPL-2-NAMED",)),
    ("LGPL-3.0-only", ("LGPL-3-NAMED",)),
    ("AGPL-3.0-only", ("AGPL-3-NAMED",)),
    ("ISC", ("ISC-GRANT",)),
    ("ISC", ("ISC-NAMED",)),
    ("0BSD", ("0BSD-GRANT",)),
    ("BSL-1.0", ("BSL-TITLE",)),
    ("BSL-1.0", ("BSL-NAMED",)),
    ("Zlib", ("ZLIB-AS-IS", "ZLIB-GRANT")),
    ("BSD-3-Clause", ("BSD-3-NAMED",)),
    ("BSD-2-Clause", ("BSD-2-NAMED",)),
    ("CC-BY-NC-SA-4.0", ("CC-BY-NC-SA-4-NAMED",)),
    ("CC-BY-NC-ND-4.0", ("CC-BY-NC-ND-4-NAMED",)),
    ("CC-BY-ND-4.0", ("CC-BY-ND-4-NAMED",)),
    ("CC0-1.0", ("CC0-WAIVED",)),
    ("CC0-1.0", ("CC0-NAMED",)),
    ("Unlicense", ("UNLICENSE",)),
    ("EPL-2.0", ("EPL-2-NAMED",)),
    ("CC-BY-NC-4.0", ("CC-BY-NC-4-NAMED",)),
    ("CC-BY-SA-4.0", ("CC-BY-SA-4-NAMED",)),
    ("CC-BY-4.0", ("CC-BY-4-NAMED",)),
    ("MPL-2.0", ("MPL-2-NAMED", "MPL-2-COPY")),
    ("MPL-2.0", ("MPL-2-NAMED",)),
    ("Apache-2.0", ("APACHE-2-TITLE",)),
    ("BSD-2-Clause", ("BSD-2-TITLE",)),
    ("BSD-3-Clause", ("BSD-3-TITLE",)),
    ("EPL-2.0", ("EPL-2-TITLE",)),
    ("AGPL-3.0-only", ("AGPL-3-TITLE",)),
    ("GPL-2.0-only", ("GPL-2-TITLE",)),
    ("GPL-3.0-only", ("GPL-3-TITLE",)),
    ("LGPL-2.1-only", ("LGPL-2-1-TITLE",)),
    ("LGPL-3.0-only", ("LGPL-3-TITLE",)),
    ("MPL-2.0", ("MPL-2-TITLE",)),
    ("Proprietary", ("RESERVED",)),
)
# a tag names any of these licences by its identifier
_TAGS = sorted({name for name, _ in RULES} - {"Proprietary"})
SENTENCES |= {"spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower()): f"SPDX-{name}" for name in _TAGS}
RULES = (*((name, (f"SPDX-{name}",)) for name in _TAGS), *RULES)
#: Rules of the third cut, before the others: a reservation in front of a licence's terms belongs to that licence.
FILE_RULES = tuple((name, ("RESERVED", *need)) for name, need in RULES if need[0] in ("BSD-GRANT", "MIT-GRANT"))
WRAPPED, LINED = r"[.!?;]+[ \t\r\n]+", r"[.!?;]+[ \t\r\n]+|\n"
#: Line marks of comments are blanks between paragraphs. A list marker is a number or a letter, not a bullet, which comments have too.
PARAGRAPHS = (
    r"(?i)[.!?;]+[ \t\r\n]+|:[ \t\r]*\n|\n[ \t\r#*/]*+\n"
    r"|\n[ \t#*/]*+(?:[0-9]{1,2}[.)]|\([0-9a-z]{1,3}\)|[a-z]\))[ \t]+"
    r"|\n(?=[ \t#*/]*+(?:permission is hereby|redistribution and use|all rights reserved))"
)
#: A line that names the owner is a paragraph of its own.
OWNER = r"(?im)^([ \t#*/]*+(?:copyright[ \t]+)?(?:\(c\)|©|copyright[ \t]+(?=[0-9<\[{]))[^\n]*)$"


def identifiers(text: Column, cut: str, sentences: Mapping[str, str]) -> Column:
    """Identifiers of the known sentences of a text, in order. Only sentences as long as a known one are normalised."""
    shortest = min(map(len, sentences), default=1)
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), cut), lambda s: F.length(s) >= shortest)
    norms = F.transform(parts, lambda s: F.trim(F.regexp_replace(ascii_lower(s), "[^a-z0-9]+", " ")))
    known = F.filter(norms, lambda s: s.isin(*sentences)) if sentences else F.filter(norms, lambda s: F.lit(False))
    names = F.create_map(*[F.lit(x) for pair in (sentences or {"": ""}).items() for x in pair])
    return F.transform(known, lambda s: F.element_at(names, s))


def licences(ids: Column, rules: Sequence[tuple[str, tuple[str, ...]]]) -> Column:
    """Licences whose rules fit an identifier sequence, in rule order; a rule uses up all its matches and leaves a break there."""
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("|" + "||".join(need) + "|").alias("need")) for name, need in rules])
    start = F.struct(F.concat_ws("", F.transform(ids, lambda i: F.concat(F.lit("|"), i, F.lit("|")))).alias("left"), F.array().cast("array<string>").alias("found"))
    step = lambda acc, r: F.when(
        F.contains(acc["left"], r["need"]),
        F.struct(F.replace(acc["left"], r["need"], F.lit("/")).alias("left"), F.array_append(acc["found"], r["name"]).alias("found")),
    ).otherwise(acc)
    return F.when(F.size(ids) == 0, F.array().cast("array<string>")).otherwise(F.aggregate(table, start, step)["found"])


def scan_licences(
    docs: DataFrame,
    text: str = "text",
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, tuple[str, ...]]] = RULES,
) -> DataFrame:
    """Add sentence_ids (known sentences in order) and licences (sorted, distinct) to every row.

    A null or empty text has neither. The whole text is read, however long; repeated rows stay repeated, and input
    columns that have one of the new names are replaced. The identifiers are those of the cut that has the most. Where
    the third cut finds every reservation in front of a licence's terms, there is no licence "Proprietary".
    """
    cuts = {"__licence_wrapped": (F.col(text), WRAPPED), "__licence_lined": (F.col(text), LINED), "__licence_filed": (F.regexp_replace(text, OWNER, "\n\n$1\n\n"), PARAGRAPHS)}
    read = docs.withColumns({name: identifiers(value, cut, sentences) for name, (value, cut) in cuts.items()})
    read = read.withColumn("__licence_file", licences(F.col("__licence_filed"), (*FILE_RULES, *rules) if rules is RULES else rules))
    owned = F.array_contains("__licence_filed", "RESERVED") & ~F.array_contains("__licence_file", "Proprietary")
    found = F.array_sort(F.array_union(F.array_union(licences(F.col("__licence_wrapped"), rules), licences(F.col("__licence_lined"), rules)), F.col("__licence_file")))
    found = F.when(owned, F.array_remove(found, "Proprietary")).otherwise(found)
    ids = F.when(F.size("__licence_lined") >= F.size("__licence_wrapped"), F.col("__licence_lined")).otherwise(F.col("__licence_wrapped"))
    ids = F.when(F.size("__licence_filed") > F.size(ids), F.col("__licence_filed")).otherwise(ids)
    return read.withColumns({"sentence_ids": ids, "licences": found}).drop(*cuts, "__licence_file")
