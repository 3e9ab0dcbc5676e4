"""Licence scan on notices as they stand in files: verbatim punctuation and line breaks."""

from __future__ import annotations

from erpweave.llm import licenses as L

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software{a} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{b} either version {v} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program{c}
"""
GPL3 = GPL.format(a=":", b=",", v=3, c=".  If not, see <https://www.gnu.org/licenses/>.")
GPL2 = GPL.format(a=";", b=";", v=2, c="; if not, write to the Free Software\nFoundation, Inc., 51 Franklin Street.")
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.licenses, r.coverage, r.identifiers) for r in L.license_report(docs).orderBy("doc_id").collect()]


def as_comment(text, sign):
    return "".join(f"{sign} {line}".rstrip() + "\n" for line in text.splitlines())


def test_notices_with_inner_punctuation(spark):
    cases = [
        ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
        ("/* SPDX-License-Identifier: Apache-2.0 */", "Apache-2.0"),
        ("# SPDX-License-Identifier: GPL-3.0-or-later\n", "GPL-3.0-or-later"),
        ("SPDX-License-Identifier:\tMIT", "MIT"),
        (MPL, "MPL-2.0"),
        (" ".join(MPL.split()), "MPL-2.0"),
        (GPL2, "GPL-2.0-or-later"),
        (GPL3, "GPL-3.0-or-later"),
        (" ".join(GPL2.split()), "GPL-2.0-or-later"),
        (" ".join(GPL3.split()), "GPL-3.0-or-later"),
    ]
    assert [x[0] for x in scan(spark, [t for t, _ in cases])] == [n for _, n in cases]


def test_a_sentence_that_goes_on_is_another_sentence(spark):
    texts = ["It is not released under the MIT License.", "Released under the MIT License or not at all.", "Released under. The MIT License."]
    assert [x[0] for x in scan(spark, texts)] == ["", "", ""]
    # A line that ends after the short form counts, also where the next line makes it the long one.
    assert scan(spark, ['Licensed under the Apache License, Version 2.0\n(the "License"); ask us.'])[0][0] == "Apache-2.0"


MIT = """MIT License

Copyright (c) 2020 Jane Doe

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
AUTHORS BE LIABLE FOR ANY CLAIM.
"""
BSD2 = """Copyright (c) 2020, Jane Doe

Redistribution and use in source and binary forms, with or without
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
"""


def test_whole_wrapped_files(spark):
    cases = [(MIT, "MIT", 4), (APACHE, "Apache-2.0", 6), (BSD2, "BSD-2-Clause", 2), (BSD3, "BSD-3-Clause", 3), (GPL3, "GPL-3.0-or-later", 3)]
    cases += [(as_comment(t, sign), n, c) for t, n, c in cases for sign in ("#", " *")]
    cases += [(t.replace("\n", "\r\n"), n, c) for t, n, c in cases[:5]]
    cases += [("\n".join(t.split()), n, c) for t, n, c in cases[:2]]
    cases += [(BSD2 + BSD3, "BSD-2-Clause,BSD-3-Clause", 3), (BSD3 + BSD2, "BSD-2-Clause,BSD-3-Clause", 3), (BSD3 + BSD3, "BSD-3-Clause", 3)]
    assert [x[:2] for x in scan(spark, [t for t, _, _ in cases])] == [(n, c) for _, n, c in cases]


def test_every_sentence_is_seen_however_it_is_wrapped(spark):
    want, texts = [], []
    for name, sentence in L.SENTENCES.items():
        words = sentence.split()
        for wrapped in (sentence, "\n".join(words), "\n * ".join(words), f"{words[0]}\n{' '.join(words[1:])}"):
            texts.append(f"Some text.\n\n{wrapped}.\n")
            want.append(name)
    assert [x[2] for x in scan(spark, texts)] == want


def test_other_catalogues_bring_their_own_hint(spark):
    docs = spark.createDataFrame([(1, "Do what you want."), (2, "Something else."), (3, None)], "doc_id long, text string")
    got = L.scan_licenses(docs, {"wtf": "do what you want", "free": "take it for free"}, (("WTF", ("wtf",)),))
    assert {r.doc_id: (r.licenses, r.coverage) for r in got.collect()} == {1: (["WTF"], 1), 2: ([], 0), 3: ([], 0)}
