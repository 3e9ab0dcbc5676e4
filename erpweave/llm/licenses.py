"""Licence scan by sentence rules (DataFrame functions only).

Texts that hold a licence word are normalised (A-Z lower-cased, everything but a-z and 0-9 one
space) up to their borders: . ! ? ; : before white space, and line breaks. A known licence
sentence counts, by its identifier, where it stands between two borders. Line breaks, blank
lines, ; and : may also stand inside it (wrapped notices, "free software; you can"), the end
of another sentence may not; the point of "v. 2.0" is no border. The identifiers of a text, in
order, are then matched against the ordered rules: a rule holds where its identifiers follow
each other.
A longer rule of a licence outranks its shorter ones by ``coverage`` and takes its sentences
from the shorter rules of other licences (a BSD-3-Clause text is no BSD-2-Clause text).

Defined cases: a null or empty text has no sentence and no licence; repeated notices count
once in ``licenses`` and each in ``n_sentences``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence sentences in their normalised form, by identifier.
SENTENCES: dict[str, str] = {
    "apache-line": "licensed under the apache license version 2 0",
    "apache-the-license": "licensed under the apache license version 2 0 the license",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-as-is": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
        "as is basis without warranties or conditions of any kind either express or implied"
    ),
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-line": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-title": "mit license",
    "mit-the-title": "the mit license mit",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"
    ),
    "mit-as-is": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties "
        "of merchantability fitness for a particular purpose and noninfringement"
    ),
    "gpl3-line": "this work is licensed under the gnu general public license version 3",
    "gpl3-licensed": "licensed under the gnu general public license version 3",
    "gpl-redistribute-3": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version"
    ),
    "gpl-redistribute-2": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 2 of the license or at your option any later version"
    ),
    "gpl-hope": (
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
        "merchantability or fitness for a particular purpose"
    ),
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "cc-by-nc-line": "licensed under cc by nc 4 0",
    "cc-by-line": "licensed under cc by 4 0",
    "cc-by-sa-line": "licensed under cc by sa 4 0",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
        "conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
    ),
    "bsd-endorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission"
    ),
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-gpl3": "spdx license identifier gpl 3 0 or later",
}

# Fixed values: (licence, identifiers that follow each other).
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("apache-line",)),
    ("Apache-2.0", ("spdx-apache",)),
    ("Apache-2.0", ("apache-the-license", "apache-may-not", "apache-obtain")),
    ("Apache-2.0", ("apache-the-license", "apache-may-not", "apache-obtain", "apache-url", "apache-as-is", "apache-see")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-endorse")),
    ("CC-BY-4.0", ("cc-by-line",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-line",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-line",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("GPL-2.0-or-later", ("gpl-redistribute-2", "gpl-hope", "gpl-received")),
    ("GPL-3.0", ("gpl3-line",)),
    ("GPL-3.0", ("gpl3-licensed",)),
    ("GPL-3.0-or-later", ("spdx-gpl3",)),
    ("GPL-3.0-or-later", ("gpl-redistribute-3", "gpl-hope", "gpl-received")),
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("spdx-mit",)),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-as-is")),
    ("MIT", ("mit-the-title", "mit-grant", "mit-notice", "mit-as-is")),
    ("MPL-2.0", ("mpl-form",)),
)

#: Every sentence of ``SENTENCES`` holds one of these words; other catalogues give their own (``hint_of``).
HINT = (
    "(?i)licen|compliance with|apache|redistribut|permission|provided as is|provided \"as is|copyright holder|free software|"
    "without any warranty|governing"
)
#: The same words, also where a notice breaks the line or puts a comment sign between them.
_HINT = HINT.replace(" ", "[^A-Za-z0-9]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hint_of(sentences: dict[str, str]) -> str:
    """What a text must hold to be looked at: the longest word of one of the sentences."""
    return "(?i)" + "|".join(sorted({max(x.split(), key=lambda w: (len(w), w)) for x in sentences.values()}))


def _bordered(text: Column) -> Column:
    """The words of a text, lower-cased: ``\\x01`` where . ! or ? ends a sentence, a line break
    after ; and : and at the end of a line, one space between other words."""
    t = F.translate(text, _UPPER + "\x01", _LOWER + " ")
    for pattern, by in (
        (r"(?<![a-z0-9])v\.\s+(?=[0-9])", "v "),
        (r"[.!?](?=\s)", "\x01"),
        (r"[;:](?=\s)", "\n"),
        (r"[^a-z0-9\x01\n]+", " "),
        (r" ?([\x01\n]) ?", "$1"),
    ):
        t = F.regexp_replace(t, pattern, by)
    return F.trim(t)


def _identifiers(bordered: Column, sentences: dict[str, str], longest: bool) -> Column:
    """The known sentences between two borders, in order; of two that start together the longest or the shortest."""
    known = F.create_map(*[F.lit(x) for name, sentence in sentences.items() for x in (sentence, name)])
    each = sorted(sentences.values(), key=lambda x: (len(x), x), reverse=longest)
    pattern = r"(?<![^\x01\n])(?:" + "|".join(x.replace(" ", r"(?: |\n+)") for x in each) + r")(?![^\x01\n])"
    return F.transform(F.regexp_extract_all(bordered, F.lit(pattern), 0), lambda x: F.element_at(known, F.regexp_replace(x, r"\n+", " ")))


def scan_licenses(
    docs: DataFrame, sentences: dict[str, str] | None = None, rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES
) -> DataFrame:
    """doc_id, licenses (sorted, distinct), n_sentences (known ones), coverage (most sentences of one rule) and identifiers."""
    hint = hint_of(sentences) if sentences else _HINT
    sentences = sentences or SENTENCES
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.expr("cast(array() as array<string>)")
    hinted = docs.select("doc_id", F.when(text.rlike(hint), text).alias("t"))
    found = hinted.select("doc_id", _bordered(F.col("t")).alias("t")).select(
        "doc_id", *[F.coalesce(_identifiers(F.col("t"), sentences, longest), none).alias(n) for n, longest in (("short", False), ("long", True))]
    )
    # The reading that knows more sentences counts for the identifiers; rules may hold in either.
    ids = F.when(F.size("short") > F.size("long"), F.col("short")).otherwise(F.col("long"))
    chains = [F.array_join(F.transform(F.col(c), lambda x: F.concat(F.lit("|"), x, F.lit("|"))), "") for c in ("short", "long")]
    found = found.select("doc_id", ids.alias("identifiers"), *[c.alias(n) for n, c in zip(("a", "b"), chains, strict=True)])

    def joined(chain: tuple[str, ...]) -> str:
        return "".join(f"|{x}|" for x in chain)

    def holds(name: str, chain: tuple[str, ...]) -> Column:
        """The chain stands in one of the readings, outside longer chains of other licences."""
        held = []
        for c in (F.col("a"), F.col("b")):
            for other, longer in sorted(rules, key=lambda r: -len(r[1])):
                if other != name and len(longer) > len(chain) and joined(chain) in joined(longer):
                    c = F.replace(c, F.lit(joined(longer)), F.lit("#"))
            held.append(F.contains(c, F.lit(joined(chain))))
        return held[0] | held[1]

    any_known = F.size("identifiers") > 0
    licences = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(holds(n, c), F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())))
    held = [F.when(holds(n, c), F.lit(len(c))).otherwise(F.lit(0)) for n, c in rules]
    coverage = F.greatest(*held) if len(held) > 1 else held[0]
    return found.select(
        "doc_id",
        F.when(any_known, licences).otherwise(none).alias("licenses"),
        F.size("identifiers").cast("long").alias("n_sentences"),
        F.when(any_known, coverage).otherwise(F.lit(0)).cast("long").alias("coverage"),
        "identifiers",
    )


def license_report(docs: DataFrame) -> DataFrame:
    """``scan_licenses`` with the lists as comma-joined strings."""
    found = scan_licenses(docs)
    return found.select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        "n_sentences",
        "coverage",
        F.array_join("identifiers", ",").alias("identifiers"),
    )
