import textwrap

import pytest

from tallyweld.llm import license as li

MIT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
ISC = """Copyright (c) 2004 A. Person

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means."""
APACHE = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
VERBATIM = " Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed."


def full(title, version):
    return f"                    {title}\n                       {version}\n\n Copyright (C) Free Software Foundation, Inc.\n{VERBATIM}\n\n                            Preamble\n"


def notice(thing, name, mark, version):
    return textwrap.fill(f"This {thing} is free software{mark[0]} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation{mark[1]} either version {version} of the License, or (at your option) any later version.", 70) + f"\n\nThis {thing} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."


TEXTS = [
    (MIT, "MIT"), (ISC, "ISC"), (ISC.replace("and/or distribute", "and distribute"), "ISC"), (BSD2, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (ZLIB, "Zlib"), (UNLICENSE, "Unlicense"), (APACHE, "Apache-2.0"), (APACHE_HEADER, "Apache-2.0"),
    (full("GNU GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"), "GPL-3.0"), (full("GNU GENERAL PUBLIC LICENSE", "Version 2, June 1991"), "GPL-2.0"),
    (full("GNU LESSER GENERAL PUBLIC LICENSE", "Version 3, 29 June 2007"), "LGPL-3.0"), (full("GNU LESSER GENERAL PUBLIC LICENSE", "Version 2.1, February 1999"), "LGPL-2.1"),
    (full("GNU AFFERO GENERAL PUBLIC LICENSE", "Version 3, 19 November 2007"), "AGPL-3.0"),
    (notice("program", "General Public License", ":,", "3"), "GPL-3.0"), (notice("program", "General Public License", ";;", "2"), "GPL-2.0"), (notice("library", "Lesser General Public License", ";;", "2.1"), "LGPL-2.1"),
    (notice("program", "Lesser General Public License", ":,", "3"), "LGPL-3.0"), (notice("program", "Affero General Public License", ":,", "3"), "AGPL-3.0"),
    ('Eclipse Public License - v 2.0\n\nTHE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE\nPUBLIC LICENSE ("AGREEMENT"). ANY USE, REPRODUCTION OR DISTRIBUTION', "EPL-2.0"),
    ("This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at\nhttps://www.eclipse.org/legal/epl-2.0/", "EPL-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed", "MPL-2.0"), ("Mozilla Public License Version 2.0\n==================================\n", "MPL-2.0"),
    ("a\nLicensed under CC BY-ND 4.0.\nb", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-NC 4.0. x", "CC-BY-NC-4.0"), ("Licensed under CC BY 4.0!", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"), ("Licensed under CC0 1.0", "CC0-1.0"), ("Hello. Released under the MIT License. Bye", "MIT"), ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    (BSD3.replace("\n3. Neither", "\n3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement:\n   This product includes software developed by A.\n\n4. Neither"), "BSD-4-Clause"),
    ("The Artistic License 2.0\n\nCopyright (c) 2000-2006, The Perl Foundation.\n\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed.", "Artistic-2.0"),
    ("COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0\n\n1. Definitions.", "CDDL-1.0"), ('The contents of this file are subject to the terms of the\nCommon Development and Distribution License (the "License").\nYou may not use this file', "CDDL-1.0"),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization\nobtaining a copy of the software and accompanying documentation covered by\nthis license (the \"Software\") to use, reproduce, display, distribute,\nexecute, and transmit the Software, and to prepare derivative works of the\nSoftware, and to permit third-parties to whom the Software is furnished to\ndo so, all subject to the following:\n", "BSL-1.0"), ("// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file)", "BSL-1.0"),
    ("SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007\n\nPREAMBLE", "OFL-1.1"), ("This Font Software is licensed under the SIL Open Font License, Version 1.1.\nThis license is copied below", "OFL-1.1"),
    ("Microsoft Public License (Ms-PL)\n\nThis license governs use of the accompanying software. If you use the software, you accept this license.", "MS-PL"),
    ("Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.", "PostgreSQL"),
    ('PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2\n--------------------------------------------\n\n1. This LICENSE AGREEMENT is between the Python Software Foundation\n("PSF"), and the Individual or Organization ("Licensee") accessing and\notherwise using this software ("Python") in source or binary form and\nits associated documentation.\n', "Python-2.0"),
    ('CC0 1.0 Universal\n\nStatement of Purpose\n\nThe laws of most jurisdictions throughout the world automatically confer\nexclusive Copyright and Related Rights (defined below) upon the creator\nand subsequent owner(s) (each and all, an "owner") of an original work of\nauthorship and/or a database (each, a "Work").\n', "CC0-1.0"),
    ("                            Preamble\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n", "GPL-3.0"), ("0. This License applies to any program or other work which contains\na notice placed by the copyright holder saying it may be distributed\nunder the terms of this General Public License.  The \"Program\", below,", "GPL-2.0"),
    ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\n                    Version 2, December 2004\n", "WTFPL"), ("University of Illinois/NCSA Open Source License\n\nCopyright (c)", "NCSA"), ('"This product includes software developed by the OpenSSL Project\nfor use in the OpenSSL Toolkit. (http://www.openssl.org/)"', ""), ("This product includes software developed by the OpenSSL Project\nfor use in the OpenSSL Toolkit (http://www.openssl.org/)", "OpenSSL"),
    ("The Apache Software License, Version 1.1\n\nCopyright (c) 2000", "Apache-1.1"), ("Eclipse Public License - v 1.0\n\nTHE ACCOMPANYING", "EPL-1.0"), ("All rights reserved. This program and the accompanying materials\nare made available under the terms of the Eclipse Public License v1.0\n", "EPL-1.0"),
    ("MOZILLA PUBLIC LICENSE Version 1.1\n", "MPL-1.1"), ('The contents of this file are subject to the Mozilla Public License Version\n1.1 (the "License"); you may not use this file except in compliance with\nthe License.', "MPL-1.1"),
    (ISC.split("granted,")[0] + "granted.\n\n" + ISC.split("\n\n")[2], "0BSD"), (MIT.split("subject to the following")[0].strip().removesuffix(",").removesuffix("so,") + ".\n\n" + MIT.split("\n\n")[-1], "MIT-0"),
    ("## ODC Open Database License (ODbL)\n", "ODbL-1.0"), ("Licensed under the EUPL, Version 1.2", "EUPL-1.2"), ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", "CC-BY-3.0"), ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0"),
    ("version\n2.0\n\n2. 0\n", ""), ("All rights reserved.", ""),
    # several at once, each read in its own way, and what only looks like one
    ("some title\nReleased under the MIT License\nmore\n\n" + BSD3, "BSD-3-Clause,MIT"), (BSD2 + "\n\n" + BSD3, "BSD-2-Clause,BSD-3-Clause"), (BSD3 + "\n\n" + BSD2, "BSD-2-Clause,BSD-3-Clause"), (MIT + "\n\n" + ISC, "ISC,MIT"),
    ("\n\n".join(reversed(MIT.split("\n\n"))), ""), ("licence of poets", ""), (None, ""), ("", ""), ("no words " * 50_000 + "\nLicensed under the Apache License, Version 2.0.", "Apache-2.0"), ("x\nLicensed under CC BY-NC 4.0.\ny " * 3, "CC-BY-NC-4.0"), (BSD2.split("2. ")[0], ""),
]


@pytest.fixture(scope="module")
def scanned(spark):
    df = spark.createDataFrame([(i, t, 0, "p", "f", "l") for i, (t, _) in enumerate(TEXTS)], "doc_id long, text string, ids int, p string, folded string, licenses string").repartition(3)
    return df, {r.doc_id: r for r in li.scan(df).collect()}


def test_licenses_of_real_texts(scanned):
    got = scanned[1]
    assert [(i, got[i].licenses) for i in range(len(TEXTS))] == [(i, want) for i, (_, want) in enumerate(TEXTS)]
    assert {x for _, w in TEXTS for x in w.split(",") if x} == {name for name, _ in li.RULES}


def test_rules_against_plain_matching(scanned):
    """Licences from the sequences of identifiers, by taking out the leftmost, shortest match of each rule again and again."""

    def match(ids, rule):
        for a, x in enumerate(ids):
            if x == rule[0]:
                at = [a]
                for want in rule[1:]:
                    nxt = next((k for k in range(at[-1] + 1, len(ids)) if ids[k] == want), None)
                    if nxt is None:
                        return None
                    at.append(nxt)
                return at
        return None

    for r in scanned[1].values():
        ids, found = [x for x in r.sentence_ids.split(",") if x], set()
        assert r.n_sentences == len(ids)
        for name, rule in li.PIECES:
            while at := match(ids, rule):
                found.add(name)
                ids = [x for k, x in enumerate(ids) if k not in at]
        assert r.licenses == ",".join(sorted(found))


def test_empty_and_repeated(scanned):
    df, got = scanned
    assert li.scan(df.limit(0)).count() == 0
    twice = li.scan(df.union(df)).collect()
    assert len(twice) == 2 * len(TEXTS) and {str(r) for r in twice} == {str(r) for r in got.values()}


def test_no_piece_is_missed(spark):
    """Each known piece by itself is a sentence: no text that holds one goes unread."""
    rows = list(enumerate(li.KNOWN))
    got = {r.doc_id: r.sentence_ids for r in li.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: li.KNOWN[k] for i, k in rows}
