"""License scans by sentence rules, in DataFrame and SQL functions only.

Texts are cut into paragraphs and these into sentences, which are normalised (letters and digits, A-Z
folded) and mapped to identifiers of known licence sentences. The sequence of identifiers of a text
is then matched against rules in their order: a licence is found where all sentences of one of its
rules follow each other, with anything between them. What a rule has matched is taken out before the
next one is tried, and rules with more sentences come first, so a licence that another one contains
is found only where it stands by itself.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

#: Sentences of public licence texts and notices.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-release": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "asis-software": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-asis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl-free": "This program is free software",
    "gpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl2-redistribute": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl-useful": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant-or": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-asis": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-asis": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "apache-title": "Apache License",
    "apache-version": "Version 2.0, January 2004",
    "apache-terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "gpl-title": "GNU GENERAL PUBLIC LICENSE",
    "lgpl-title": "GNU LESSER GENERAL PUBLIC LICENSE",
    "agpl-title": "GNU AFFERO GENERAL PUBLIC LICENSE",
    "gpl3-version": "Version 3, 29 June 2007",
    "gpl2-version": "Version 2, June 1991",
    "lgpl21-version": "Version 2.1, February 1999",
    "agpl3-version": "Version 3, 19 November 2007",
    "gnu-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed",
    "lgpl-free": "This library is free software",
    "lgpl21-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "lgpl-useful": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "agpl3-redistribute": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "epl2-title": "Eclipse Public License - v 2.0",
    "epl2-accompanying": "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\")",
    "epl2-made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "unlicense-free": "This is free and unencumbered software released into the public domain",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means",
    "zlib-asis": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software",
    "mpl-title": "Mozilla Public License Version 2.0",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v",  # what follows is its number, 2.0
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "cc-by-4": "Licensed under CC BY 4.0",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0",
    "cc-by-nd-4": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa-4": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-4-deed": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc0-1": "Licensed under CC0 1.0",
    "bsd-advert": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "artistic2-title": "The Artistic License 2.0",
    "cddl1-title": "COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0",
    "cddl-header": "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\")",
    "bsl1-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "bsl1-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following",
    "bsl1-header": "Distributed under the Boost Software License, Version 1.0",
    "ofl11-title": "SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007",
    "ofl11-header": "This Font Software is licensed under the SIL Open Font License, Version 1.1",
    "mspl-title": "Microsoft Public License (Ms-PL)",
    "mspl-governs": "This license governs use of the accompanying software",
    "postgresql-grant": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    "python2-title": "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2",
    "python2-between": "This LICENSE AGREEMENT is between the Python Software Foundation (\"PSF\"), and the Individual or Organization (\"Licensee\") accessing and otherwise using this software (\"Python\") in source or binary form and its associated documentation",
    "cc0-title": "CC0 1.0 Universal",
    "cc0-purpose": "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")",
    "gpl3-preamble": "The GNU General Public License is a free, copyleft license for software and other kinds of works",
    "gpl2-applies": "This License applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this General Public License",
    "wtfpl-title": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
    "wtfpl-version": "Version 2, December 2004",
    "ncsa-title": "University of Illinois/NCSA Open Source License",
    "openssl-product": "This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit (http://www.openssl.org/)",
    "apache11-title": "The Apache Software License, Version 1.1",
    "epl1-title": "Eclipse Public License - v 1.0",
    "epl1-made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0",
    "mpl11-title": "MOZILLA PUBLIC LICENSE Version 1.1",
    "mpl11-header": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "odbl1-title": "ODC Open Database License (ODbL)",
    "eupl12-header": "Licensed under the EUPL, Version 1.2",
    "cc-by-3": "This work is licensed under a Creative Commons Attribution 3.0 Unported License",
    "cc-by-sa-3": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License",
    "rights-reserved": "All rights reserved",
}
#: Fixed values: (licence, ordered sentence identifiers).
RULES = [
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("MIT", ["mit-grant", "mit-notice", "asis-software"]),
    ("Apache-2.0", ["apache-header", "apache-comply", "apache-copy"]),
    ("Apache-2.0", ["apache-title", "apache-version", "apache-terms"]),
    ("AGPL-3.0", ["agpl-title", "agpl3-version", "gnu-verbatim"]),
    ("LGPL-3.0", ["lgpl-title", "gpl3-version", "gnu-verbatim"]),
    ("LGPL-2.1", ["lgpl-title", "lgpl21-version", "gnu-verbatim"]),
    ("GPL-3.0", ["gpl-title", "gpl3-version", "gnu-verbatim"]),
    ("GPL-2.0", ["gpl-title", "gpl2-version", "gnu-verbatim"]),
    ("AGPL-3.0", ["gpl-free", "agpl3-redistribute", "gpl-useful"]),
    ("LGPL-2.1", ["lgpl-free", "lgpl21-redistribute", "lgpl-useful"]),
    ("LGPL-3.0", ["gpl-free", "lgpl3-redistribute", "gpl-useful"]),
    ("GPL-3.0", ["gpl-free", "gpl3-redistribute", "gpl-useful"]),
    ("GPL-2.0", ["gpl-free", "gpl2-redistribute", "gpl-useful"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("Zlib", ["zlib-asis", "zlib-grant", "zlib-origin"]),
    ("ISC", ["isc-grant", "isc-asis"]),
    ("ISC", ["isc-grant-or", "isc-asis"]),
    ("EPL-2.0", ["epl2-title", "epl2-accompanying"]),
    ("Artistic-2.0", ["artistic2-title", "gnu-verbatim"]),
    ("BSL-1.0", ["bsl1-title", "bsl1-grant"]),
    ("MS-PL", ["mspl-title", "mspl-governs"]),
    ("Python-2.0", ["python2-title", "python2-between"]),
    ("CC0-1.0", ["cc0-title", "cc0-purpose"]),
    ("WTFPL", ["wtfpl-title", "wtfpl-version"]),
    ("MIT-0", ["mit0-grant", "asis-software"]),
    ("0BSD", ["0bsd-grant", "isc-asis"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("MIT", ["mit-release"]),
    ("MIT", ["mit-licensed"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("GPL-3.0", ["gpl3-work"]),
    ("EPL-2.0", ["epl2-made"]),
    ("MPL-2.0", ["mpl-title"]),
    ("MPL-2.0", ["mpl-form"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-4.0", ["cc-by-4-deed"]),
    ("CC0-1.0", ["cc0-1"]),
    ("CC-BY-3.0", ["cc-by-3"]),
    ("CC-BY-SA-3.0", ["cc-by-sa-3"]),
    ("CDDL-1.0", ["cddl1-title"]),
    ("CDDL-1.0", ["cddl-header"]),
    ("BSL-1.0", ["bsl1-header"]),
    ("OFL-1.1", ["ofl11-title"]),
    ("OFL-1.1", ["ofl11-header"]),
    ("PostgreSQL", ["postgresql-grant"]),
    ("GPL-3.0", ["gpl3-preamble"]),
    ("GPL-2.0", ["gpl2-applies"]),
    ("NCSA", ["ncsa-title"]),
    ("OpenSSL", ["openssl-product"]),
    ("Apache-1.1", ["apache11-title"]),
    ("EPL-1.0", ["epl1-title"]),
    ("EPL-1.0", ["epl1-made"]),
    ("MPL-1.1", ["mpl11-title"]),
    ("MPL-1.1", ["mpl11-header"]),
    ("ODbL-1.0", ["odbl1-title"]),
    ("EUPL-1.2", ["eupl12-header"]),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts paragraphs, and ends of sentences within one: a mark and white space, or the end of a
#: line. The second form reads lines that do not end in a mark as going on, as in wrapped texts.
PARAGRAPHS = r"\n[ \t\r]*\n"
BREAKS = (r"[.;:!?][ \t\r]+|[.;:!?]?[ \t\r]*\n", r"[.;:!?][ \t\r\n]+")


def normal(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip()


KNOWN: dict[str, str] = {}
for _id, _text in SENTENCES.items():  # a sentence with a break inside is known by the pieces' sequence
    _pieces = [p for p in (normal(x) for x in re.split(BREAKS[1], _text)) if p]
    for _k, _piece in enumerate(_pieces):
        KNOWN.setdefault(_piece, _id if _k == len(_pieces) - 1 else f"{_id}.{_k}")
#: Rules over the identifiers of pieces: a sentence with a break inside is found where all of its pieces are.
PIECES = [(name, [KNOWN[p] for x in ids for p in (normal(y) for y in re.split(BREAKS[1], SENTENCES[x])) if p]) for name, ids in RULES]


def _one_of_each(pieces: list[str]) -> list[str]:
    """Few words such that each piece holds one of them: the one in most of the pieces left, long words first."""
    out, left = [], [set(p.split()) for p in pieces]
    while left:
        words = {w for p in left for w in p}
        best = max(sorted(words), key=lambda w: (len(w) > 6, len(w) > 4, sum(w in p for p in left), len(w)))
        out.append(best)
        left = [p for p in left if best not in p]
    return out


#: A text without any of these words holds no known piece, so it need not be cut into sentences.
TRIGGERS = _one_of_each(list(KNOWN))


def _pattern(ids: list[str]) -> str:
    """A rule over identifiers in angle brackets; groups hold what lies between them."""
    return "((?:<[^>]*>)*?)".join(f"<{x}>" for x in ids)


def _between(ids: list[str], group: str) -> str:
    return "".join(f"{group}{k}" for k in range(1, len(ids)))


def _ids() -> str:
    listed = ", ".join(f"'{k}'" for k in KNOWN)
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in KNOWN.items())
    slash = lambda x: x.replace("\\", "\\\\")
    read = lambda b: f"transform(filter(transform(split(p, '{slash(b)}'), s -> trim(regexp_replace(s, '[^a-z0-9]+', ' '))), s -> s IN ({listed})), s -> element_at(map({pairs}), s))"
    better = f"transform(array({read(BREAKS[0])}), x -> transform(array({read(BREAKS[1])}), y -> CASE WHEN size(y) > size(x) THEN y ELSE x END)[0])[0]"
    return f"flatten(transform(split(folded, '{slash(PARAGRAPHS)}'), p -> {better}))"


def _licenses() -> str:
    rules = ", ".join(f"struct('{_pattern(ids)}' AS p, '{_between(ids, '$')}' AS kept, '{name}' AS name)" for name, ids in PIECES)
    step = "CASE WHEN s.line RLIKE r.p THEN struct(regexp_replace(s.line, r.p, r.kept) AS line, concat(s.found, array(r.name)) AS found) ELSE s END"
    return f"aggregate(array({rules}), struct(concat('<', array_join(ids, '><'), '>') AS line, cast(array() AS array<string>) AS found), (s, r) -> {step}, s -> array_join(array_sort(array_distinct(s.found)), ','))"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_sentences (known ones), sentence_ids, licenses.

    sentence_ids lists the identifiers in the order of the text, licenses the licences found by name,
    both joined by commas and empty if there are none. In each paragraph, of the two readings of line
    ends the one that knows more sentences counts, the first on a tie. A null text has no sentences;
    a very long one is read whole. Repeated rows give repeated results; other columns are not read,
    whatever their names. No rows in, no rows out.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), UPPER, LOWER).alias("folded"))
    none = F.array().cast("array<string>")
    rows = rows.select("doc_id", F.when(F.col("folded").rlike("|".join(TRIGGERS)), F.expr(_ids())).otherwise(none).alias("ids"))
    found = F.when(F.size("ids") > 0, F.expr(_licenses())).otherwise("")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"), found.alias("licenses"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Known licence sentences and licences of every document."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def duckdb_sql() -> str:
    listed = ", ".join(f"'{k}'" for k in KNOWN)
    names = ", ".join(f"'{v}'" for v in KNOWN.values())
    ids = lambda b: f"list_transform(list_filter(list_transform(regexp_split_to_array(p, '{b}'), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: s IN ({listed})), lambda s: list_extract([{names}], list_position([{listed}], s)))"
    steps = ["r0 AS (SELECT doc_id, ids, list_aggregate(list_transform(ids, lambda x: '<' || x || '>'), 'string_agg', '') AS line, []::VARCHAR[] AS found FROM i WHERE len(ids) > 0)"]
    for k, (name, own) in enumerate(PIECES):
        hit = f"regexp_matches(line, '{_pattern(own)}')"
        kept = _between(own, "\\")
        steps.append(f"r{k + 1} AS (SELECT doc_id, ids, regexp_replace(line, '{_pattern(own)}', '{kept}', 'g') AS line, CASE WHEN {hit} THEN list_append(found, '{name}') ELSE found END AS found FROM r{k})")
    return f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS folded FROM documents),
b AS (SELECT doc_id, k, {ids(BREAKS[0])} AS by_line, {ids(BREAKS[1])} AS by_text FROM (SELECT doc_id, unnest(parts) AS p, unnest(range(len(parts))) AS k FROM (SELECT doc_id, regexp_split_to_array(folded, '{PARAGRAPHS}') AS parts FROM t))),
i AS (SELECT doc_id, flatten(list(CASE WHEN len(by_text) > len(by_line) THEN by_text ELSE by_line END ORDER BY k)) AS ids FROM b GROUP BY doc_id),
{', '.join(steps)}
SELECT t.doc_id, coalesce(len(ids), 0)::BIGINT AS n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(list_sort(list_distinct(found)), ','), '') AS licenses
FROM t LEFT JOIN r{len(RULES)} r ON r.doc_id = t.doc_id"""
