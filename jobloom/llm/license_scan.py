"""Licence scans by sentence rules, in DataFrame functions only.

Texts are cut to sentences, sentences are normalised (lower case, runs of all but
letters and digits as one space) and mapped to identifiers of known licence
sentences.  The identifiers in reading order are matched against ordered rules: a
rule holds if its identifiers stand in that order; other known ones may stand
between.  Sentences that name an owner, or in which a licence's name stands among other
words, are known by patterns, as are the names in SPDX expressions.  Sentences are cut twice, once at line ends too and once with lines
joined, since licence texts come wrapped and as single lines; in a comment, lines
of marks alone part paragraphs as empty lines do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences of public licences, in normal form and as ``_pieces`` cuts them ("free software: you can", "v. 2.0"); whole too, for texts without the cut's sign.
SENTENCES = {
    "apache_by_name": ["licensed under the apache license version 2 0", "licensed under the apache license 2 0", "this project is licensed under the apache license version 2 0"],
    "apache_header": ["licensed under the apache license version 2 0 the license"],
    "apache_comply": ["you may not use this file except in compliance with the license"],
    "apache_obtain": ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at https www apache org licenses license 2 0", "you may obtain a copy of the license at"],
    "apache_as_is": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "mit_by_name": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license"],
    "mit_grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit_notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "mit_as_is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "bsd_grant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd_source": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsd_binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd_endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "isc_grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "gpl2_by_name": ["licensed under the gnu general public license version 2", "this program is licensed under the gnu general public license version 2", "this work is licensed under the gnu general public license version 2"],
    "gpl3_by_name": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "this program is licensed under the gnu general public license version 3"],
    "gpl_program": ["this program is free software"],
    "lgpl_library": ["this library is free software"],
    "gpl_terms": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl_terms": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "version_2": ["either version 2 of the license or at your option any later version"],
    "version_2_1": ["either version 2 1 of the license or at your option any later version"],
    "version_3": ["either version 3 of the license or at your option any later version"],
    "gpl_free": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "lgpl3_free": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "agpl_free": ["you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl_useful": ["this program is distributed in the hope that it will be useful but without any warranty", "this library is distributed in the hope that it will be useful but without any warranty"],
    "gpl_hope": ["without even the implied warranty of merchantability or fitness for a particular purpose", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "mpl_subject": ["this source code form is subject to the terms of the mozilla public license v", "this source code form is subject to the terms of the mozilla public license v 2 0"],
    "mpl_obtain": ["if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"],
    "cc_by": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc_by_sa": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "cc_by_nc": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "cc0": ["licensed under cc0 1 0", "this work is licensed under cc0 1 0", "this work is licensed under cc0 1 0 universal"],
    "zlib_as_is": ["this software is provided as is without any express or implied warranty"],
    "zlib_grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "boost": ["distributed under the boost software license version 1 0"],
    "epl2_available": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at http www eclipse org legal epl 2 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "mit_title": ["mit license", "the mit license", "the mit license mit"],
    "gpl3_title": ["gnu general public license version 3 29 june 2007", "gnu general public license version 3"],
    "gpl2_title": ["gnu general public license version 2 june 1991", "gnu general public license version 2"],
    "lgpl3_title": ["gnu lesser general public license version 3 29 june 2007"],
    "agpl3_title": ["gnu affero general public license version 3 19 november 2007"],
    "apache_title": ["apache license version 2 0 january 2004"],
    "gpl_name": ["gnu general public license"],
    "lgpl_name": ["gnu lesser general public license"],
    "agpl_name": ["gnu affero general public license"],
    "apache_name": ["apache license"],
    "dated_version_2": ["version 2 june 1991"],
    "dated_version_3": ["version 3 29 june 2007"],
    "dated_version_3_network": ["version 3 19 november 2007"],
    "dated_version_2_0": ["version 2 0 january 2004"],
}

_UNDER = "(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?"
_GNU = _UNDER + "(?:gnu )?(?:gpl|general public licen[sc]e)(?: version| v)? ?v?"
#: Patterns of sentences with slots, in normal form, for those that aren't known as they are.
PATTERNS = [
    ("bsd_endorse", "(?:^| )may be used to endorse or promote products derived from this software without specific prior written permission(?: |$)"),
    ("mit_by_name", _UNDER + "(?:mit|expat)(?: |$)"),
    ("apache_by_name", _UNDER + "apache (?:software )?(?:licen[sc]e )?(?:version )?v?2(?: 0)?(?: |$)"),
    ("gpl2_by_name", _GNU + "2(?: |$)"),
    ("gpl3_by_name", _GNU + "3(?: |$)"),
]

#: Ordered rules, (licence, identifiers).
RULES = [
    ("AGPL-3.0", ["agpl_free", "gpl_hope"]),
    ("Apache-2.0", ["apache_by_name"]),
    ("Apache-2.0", ["apache_header", "apache_comply"]),
    ("Apache-2.0", ["apache_comply", "apache_as_is"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSL-1.0", ["boost"]),
    ("CC-BY-4.0", ["cc_by"]),
    ("CC-BY-NC-4.0", ["cc_by_nc"]),
    ("CC-BY-SA-4.0", ["cc_by_sa"]),
    ("CC0-1.0", ["cc0"]),
    ("EPL-2.0", ["epl2_available"]),
    ("GPL-2.0", ["gpl2_by_name"]),
    ("GPL-2.0", ["gpl_terms", "version_2", "gpl_hope"]),
    ("GPL-3.0", ["gpl3_by_name"]),
    ("GPL-3.0", ["gpl_free", "gpl_hope"]),
    ("GPL-3.0", ["gpl_terms", "version_3", "gpl_hope"]),
    ("ISC", ["isc_grant"]),
    ("LGPL-2.1", ["lgpl_terms", "version_2_1", "gpl_hope"]),
    ("LGPL-3.0", ["lgpl3_free", "gpl_hope"]),
    ("LGPL-3.0", ["lgpl_terms", "version_3", "gpl_hope"]),
    ("MIT", ["mit_by_name"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_as_is"]),
    ("MPL-2.0", ["mpl_subject", "mpl_obtain"]),
    ("Unlicense", ["unlicense"]),
    ("MIT", ["mit_title"]),
    ("GPL-3.0", ["gpl3_title"]),
    ("GPL-3.0", ["gpl_name", "dated_version_3"]),
    ("GPL-2.0", ["gpl2_title"]),
    ("GPL-2.0", ["gpl_name", "dated_version_2"]),
    ("LGPL-3.0", ["lgpl3_title"]),
    ("LGPL-3.0", ["lgpl_name", "dated_version_3"]),
    ("AGPL-3.0", ["agpl3_title"]),
    ("AGPL-3.0", ["agpl_name", "dated_version_3_network"]),
    ("Apache-2.0", ["apache_title"]),
    ("Apache-2.0", ["apache_name", "dated_version_2_0"]),
]

#: Names that follow "SPDX-License-Identifier:"; the sentence and rule of each are made below.
SPDX = ("0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib")


def _normal_name(name: str) -> str:
    return "".join(c if c.isalnum() else " " for c in name.lower())


_SPDX = "spdx license identifier "
#: Names in an SPDX expression, by patterns of its normal form.
SPDX_PATTERNS = [("spdx_" + _normal_name(x).replace(" ", "_"), f"^{_SPDX}(?:.* )?{_normal_name(x)}(?: |$)") for x in SPDX]
RULES += [(x, [i]) for x, (i, _) in zip(SPDX, SPDX_PATTERNS)]
RULES.append(("Zlib", ["zlib_as_is", "zlib_grant"]))

#: Characters of the shortest known sentence: a shorter piece is none.
SHORTEST = min(len(x) for xs in SENTENCES.values() for x in xs)
#: Every known sentence has one of these words; texts without them need no cutting.
HINTS = ("licen", "under mit", "under the mit", "under apache", "under gpl", "under the gpl", "under gnu", "cc0", "permi", "redistribut", "neither the name", "notice", "warrant", "free software", "mpl", "unencumbered")


#: The colon of an SPDX line ends no sentence.
_SPDX_COLON = "(?i)(spdx-license-identifier):"
#: What is left of an empty line in a comment.
_BARE_MARKS = "\\n[ \\t\\r]*[#*/;%-]+[ \\t\\r]*(?=\\n)"


def _pieces(text: Column) -> Column:
    return F.split(F.regexp_replace(F.regexp_replace(text, _SPDX_COLON, "$1 "), "[.;:!?][ \\t\\r\\n]+", "\n"), "\n")


def _identifiers(pieces: Column) -> Column:
    """Identifiers of known sentences: whole ones by a table, names in an SPDX expression, else those whose pattern is met."""
    normal = lambda x: F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))
    known = {s: name for name, xs in SENTENCES.items() for s in xs}
    table = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
    met = lambda x, patterns: F.filter(F.array(*[F.when(x.rlike(p), F.lit(name)) for name, p in patterns]), lambda y: y.isNotNull())
    hinted = lambda x: x.contains(" under ") | x.contains("endorse or promote")
    of = lambda x: F.when(x.isin(*sorted(known)), F.array(F.element_at(table, x))).when(x.startswith(_SPDX), met(x, SPDX_PATTERNS)).when(hinted(x), met(x, PATTERNS)).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(F.transform(F.filter(pieces, lambda x: F.length(x) >= SHORTEST), normal), of))


def _rule_pattern(names: list[str]) -> str:
    return ",(?:" + ",(?:[a-z0-9_]+,)*".join(f"{n}" for n in names) + "),"


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_sentences (known ones), sentence_ids (comma-joined, in order), licenses (comma-joined, sorted; BSD-3-Clause hides BSD-2-Clause).

    A null or empty text has none and gives empty strings.  Repeated rows are
    scanned each; a null id stays null; other columns are ignored.  An empty table
    gives an empty result.  One pass over whole texts, no shuffle.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    able = docs.select(F.col(id_column), text.alias("__text")).withColumn("__able", F.lower("__text").rlike("|".join(HINTS)))
    none = F.array().cast("array<string>")
    lines = F.when(F.col("__able"), _identifiers(_pieces(F.col("__text")))).otherwise(none)
    whole = F.when(F.col("__able"), _identifiers(_pieces(F.regexp_replace(F.regexp_replace(F.regexp_replace("__text", _BARE_MARKS, "\n"), "\\n[ \\t\\r]*\\n", ". \n"), "[ \\t\\r]*\\n[ \\t\\r]*(?:[#*/]+[ \\t]+)?", " ")))).otherwise(none)
    found = able.withColumn("__lines", lines).withColumn("__whole", whole)
    found = found.withColumn("__ids", F.when(F.size("__whole") > F.size("__lines"), F.col("__whole")).otherwise(F.col("__lines")))
    found = found.withColumn("__first", F.concat(F.lit(","), F.array_join("__lines", ","), F.lit(","))).withColumn("__second", F.concat(F.lit(","), F.array_join("__whole", ","), F.lit(",")))
    hit = lambda names: F.col("__first").rlike(_rule_pattern(names)) | F.col("__second").rlike(_rule_pattern(names))
    names = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(hit(names), F.lit(name)) for name, names in RULES]), lambda x: x.isNotNull())))
    names = F.when(F.array_contains(names, "BSD-3-Clause"), F.array_remove(names, "BSD-2-Clause")).otherwise(names)
    return found.select(id_column, F.size("__ids").cast("bigint").alias("n_sentences"), F.array_join("__ids", ",").alias("sentence_ids"), F.array_join(names, ",").alias("licenses"))


def oracle_sql() -> str:
    """The scan of ``documents`` in DuckDB's SQL.  Its patterns know no look-ahead, so lines of comment marks are found line by line."""
    known = sorted((s, name) for name, xs in SENTENCES.items() for s in xs)
    table = "map {" + ", ".join(f"'{s}': '{n}'" for s, n in known) + "}"
    met = lambda patterns: "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(p, '{p}') THEN '{n}' END" for n, p in patterns) + "], lambda z: z IS NOT NULL)"
    of = f"CASE WHEN map_contains(k, p) THEN [k[p]] WHEN starts_with(p, '{_SPDX}') THEN {met(SPDX_PATTERNS)} WHEN contains(p, ' under ') OR contains(p, 'endorse or promote') THEN {met(PATTERNS)} ELSE [] END"
    ids = lambda x: f"flatten(list_transform(list_transform(list_filter(string_split(regexp_replace(regexp_replace({x}, '(?i)(spdx-license-identifier):', '\\1 ', 'g'), '[.;:!?][ \\t\\r\\n]+', chr(10), 'g'), chr(10)), lambda p: length(p) >= {SHORTEST}), lambda p: trim(regexp_replace(lower(p), '[^a-z0-9]+', ' ', 'g'))), lambda p: {of}))"
    rules = ", ".join(f"CASE WHEN regexp_matches(a, '{_rule_pattern(r)}') OR regexp_matches(b, '{_rule_pattern(r)}') THEN '{n}' END" for n, r in RULES)
    return f"""
    WITH s AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines, {table} AS k FROM documents),
    t AS (SELECT doc_id, text, k, array_to_string(list_transform(lines, lambda x, i: CASE WHEN i > 1 AND i < len(lines) AND regexp_full_match(x, '[ \\t\\r]*[#*/;%-]+[ \\t\\r]*') THEN '' ELSE x END), chr(10)) AS bare FROM s),
    u AS (SELECT doc_id, {ids("text")} AS x, {ids("regexp_replace(regexp_replace(bare, '\\n[ \\t\\r]*\\n', '. ' || chr(10), 'g'), '[ \\t\\r]*\\n[ \\t\\r]*(?:[#*/]+[ \\t]+)?', ' ', 'g')")} AS y FROM t),
    v AS (SELECT doc_id, CASE WHEN len(y) > len(x) THEN y ELSE x END AS ids, ',' || array_to_string(x, ',') || ',' AS a, ',' || array_to_string(y, ',') || ',' AS b FROM u),
    w AS (SELECT *, list_sort(list_distinct(list_filter([{rules}], lambda z: z IS NOT NULL))) AS l FROM v)
    SELECT doc_id, len(ids) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
           array_to_string(CASE WHEN list_contains(l, 'BSD-3-Clause') THEN list_filter(l, lambda z: z <> 'BSD-2-Clause') ELSE l END, ',') AS licenses FROM w"""
