"""Licence scan by sentence rules, in DataFrame functions only.

Sentences. A text is cut at line ends and after ``.``, ``;``, ``!`` or ``?``
before white space; a sentence is normalised by folding A-Z and turning every
run of other characters than a-z and 0-9 into one blank. Known licence
sentences map to identifiers; all others are left out.

Wrapped text. A known sentence may also run over several lines: its words are
then matched over line ends, but not over blank lines (lines of marks only
included) or the ends of sentences. A line that is a known sentence by itself
stays one. ``n_sentences`` counts what the cut gives, wrapped or not.

Slots. A ``*`` inside a known sentence stands for one to ``SLOT`` words, such
as the name of a holder; at its end, for the rest of the sentence, if any.

Rules. A document's identifiers, in order, are matched against an ordered
list of rules: at each place the first rule whose identifier sequence follows
there claims it and names a licence, and matching goes on behind it.
Identifiers no rule claims are counted. ``YIELDS`` lists names that count only
where no other licence follows: a copyright line's "all rights reserved" before
a licence reserves nothing.

The whole scan is a projection: split, transform, filter and look-up within
the row, no shuffle, so neither hot sources nor copies matter. The sentence
table and the rules are parameters, small literals of the plan.

One row per input row: a null text is the empty text (no sentences), null ids
and repeated rows are kept, an empty table gives no rows. A licence named
several times in a text is listed once, in order of first appearance.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CUT = r"[\n\r]+|[.;!?][ \t]+"
OTHER = r"[^a-z0-9]+"
# In folded text, capitals are free to mark ends: H, which no sentence runs over, and L, a single line end.
MARKS = ((r"[.;!?][ \t]*(?=[\n\r])|[.;!?][ \t]+", "H"), (r"(?>\r\n|[\n\r])(?=[^a-zA-Z0-9\n\r]*[\n\r])", "H"), (r"[\n\r]+", "L"),
         (r"[^a-z0-9HL]+", " "), (r"[ HL]*H[ HL]*", "H"), (r" ?L ?", "L"))

SLOT, REST = 12, 40
YIELDS = ("proprietary",)

# Identifiers of licences as files name them in one line.
SPDX = ("MIT", "MIT-0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "0BSD", "ISC", "Zlib", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0",
        "EPL-1.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "Unlicense", "BSL-1.0", "Artistic-2.0")
# Names of licences in running text, and what they name.
NAMED = {"mit license": "MIT_NAMED", "apache license version 2 0": "APACHE_NAMED", "bsd 3 clause license": "BSD3_NAMED", "bsd 2 clause license": "BSD2_NAMED",
         "gnu general public license version 3": "GPL3_NAMED", "gnu general public license version 2": "GPL2_NAMED",
         "gnu lesser general public license version 3": "LGPL3_NAMED", "gnu lesser general public license version 2 1": "LGPL21_NAMED",
         "gnu affero general public license version 3": "AGPL3_NAMED", "mozilla public license version 2 0": "MPL2_NAMED", "eclipse public license version 2 0": "EPL2_NAMED",
         "isc license": "ISC_NAMED", "zlib license": "ZLIB_NAMED", "artistic license 2 0": "ARTISTIC2_NAMED"}

# Normalised sentences of public licence texts and notices.
SENTENCES: dict[str, str] = {
    **{f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', i.lower())}": f"SPDX_{i}" for i in SPDX},
    **{f"this * is {how} under the {name} *": i for how in ("licensed", "released") for name, i in NAMED.items()},
    "this is free software you can redistribute it and or modify it under the terms of the artistic license 2 0 *": "ARTISTIC2_NAMED",
    "the artistic license 2 0": "ARTISTIC2_NAMED",
    "zlib license": "ZLIB_NAMED",
    "this software is provided as is without any express or implied warranty": "ZLIB_WARRANTY",
    "in no event will the authors be held liable for any damages arising from the use of this software": "ZLIB_LIABILITY",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZLIB_GRANT",
    "to the extent possible under law * has waived all copyright and related or neighboring rights to *": "CC0_WAIVER",
    "creative commons legal code": "CC_CODE",
    "cc0 1 0 universal": "CC0_TITLE",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 *": "EPL2_TERMS",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 *": "EPL1_TERMS",
    "this library is free software": "LGPL_FREE",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPL21_TERMS",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "LGPL_UNDER",
    "either version 2 1 of the license or at your option any later version": "LGPL21_LATER",
    "this library is distributed in the hope that it will be useful but without any warranty": "LGPL_HOPE",
    "see the gnu lesser general public license for more details": "LGPL_SEE",
    "licensed under the apache license version 2 0": "APACHE_NAMED",
    "licensed under the apache license version 2 0 the license": "APACHE_HEAD",
    "you may not use this file except in compliance with the license": "APACHE_USE",
    "you may obtain a copy of the license at": "APACHE_COPY",
    "http www apache org licenses license 2 0": "APACHE_URL",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "APACHE_WARRANTY",
    "see the license for the specific language governing permissions and limitations under the license": "APACHE_SEE",
    "released under the mit license": "MIT_NAMED",
    "licensed under the mit license": "MIT_NAMED",
    "mit license": "MIT_TITLE",
    "the mit license": "MIT_TITLE",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MIT_GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MIT_NOTICE",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MIT_WARRANTY",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MIT_LIABILITY",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSD_GRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSD_SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSD_BINARY",
    "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD_NAME",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "BSD_ADVERT",
    "this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSD_WARRANTY",
    "licensed under the bsd 3 clause license": "BSD3_NAMED",
    "licensed under the bsd 2 clause license": "BSD2_NAMED",
    "this work is licensed under the gnu general public license version 3": "GPL3_NAMED",
    "licensed under the gnu general public license version 3": "GPL3_NAMED",
    "licensed under the gnu general public license version 2": "GPL2_NAMED",
    "this program is free software": "GPL_FREE",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3_TERMS",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2_TERMS",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "GPL_UNDER",
    "either version 3 of the license or at your option any later version": "GPL3_LATER",
    "either version 2 of the license or at your option any later version": "GPL2_LATER",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3_WHOLE",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2_WHOLE",
    "this program is distributed in the hope that it will be useful but without any warranty": "GPL_HOPE",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "GPL_IMPLIED",
    "see the gnu general public license for more details": "GPL_SEE",
    "licensed under the gnu lesser general public license version 3": "LGPL3_NAMED",
    "licensed under the gnu affero general public license version 3": "AGPL3_NAMED",
    "licensed under cc by 4 0": "CC_BY",
    "licensed under cc by sa 4 0": "CC_BY_SA",
    "licensed under cc by nc 4 0": "CC_BY_NC",
    "licensed under cc by nd 4 0": "CC_BY_ND",
    "this work is licensed under a creative commons attribution 4 0 international license": "CC_BY",
    "this is free and unencumbered software released into the public domain": "UNLICENSE_FREE",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2_TERMS",
    "this source code form is subject to the terms of the mozilla public license v": "MPL2_TERMS",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "MPL2_COPY",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC_GRANT",
    "boost software license version 1 0": "BSL1_TITLE",
    "boost software license version 1 0 august 17th 2003": "BSL1_TITLE",
    "distributed under the boost software license version 1 0": "BSL1_TITLE",
    "all rights reserved": "ALL_RIGHTS",
}

SENTENCES |= {f"{how} under the {name}": i for how in ("licensed", "released") for name, i in NAMED.items()}

#: Ordered: longer and more specific sequences come before what they contain.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    *((i, (f"SPDX_{i}",)) for i in SPDX),
    ("Apache-2.0", ("APACHE_HEAD", "APACHE_USE", "APACHE_COPY", "APACHE_URL", "APACHE_WARRANTY", "APACHE_SEE")),
    ("Apache-2.0", ("APACHE_HEAD", "APACHE_USE", "APACHE_COPY")),
    ("Apache-2.0", ("APACHE_HEAD",)),
    ("Apache-2.0", ("APACHE_NAMED",)),
    ("MIT", ("MIT_TITLE", "MIT_GRANT", "MIT_NOTICE", "MIT_WARRANTY", "MIT_LIABILITY")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE", "MIT_WARRANTY", "MIT_LIABILITY")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE", "MIT_WARRANTY")),
    ("MIT", ("MIT_NAMED",)),
    ("MIT", ("MIT_TITLE",)),
    ("BSD-4-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ADVERT", "BSD_NAME", "BSD_WARRANTY")),
    ("BSD-4-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_ADVERT", "BSD_NAME")),
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_NAME", "BSD_WARRANTY")),
    ("BSD-3-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_NAME")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_WARRANTY")),
    ("BSD-2-Clause", ("BSD_GRANT", "BSD_SOURCE", "BSD_BINARY")),
    ("BSD-3-Clause", ("BSD3_NAMED",)),
    ("BSD-2-Clause", ("BSD2_NAMED",)),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL3_TERMS", "GPL_HOPE", "GPL_IMPLIED", "GPL_SEE")),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL3_TERMS")),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL_UNDER", "GPL3_LATER", "GPL_HOPE", "GPL_IMPLIED", "GPL_SEE")),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL_UNDER", "GPL3_LATER")),
    ("GPL-3.0-or-later", ("GPL3_WHOLE", "GPL_HOPE", "GPL_IMPLIED", "GPL_SEE")),
    ("GPL-3.0-or-later", ("GPL3_WHOLE",)),
    ("GPL-2.0-or-later", ("GPL_FREE", "GPL2_TERMS", "GPL_HOPE", "GPL_IMPLIED", "GPL_SEE")),
    ("GPL-2.0-or-later", ("GPL_FREE", "GPL2_TERMS")),
    ("GPL-2.0-or-later", ("GPL_FREE", "GPL_UNDER", "GPL2_LATER", "GPL_HOPE", "GPL_IMPLIED", "GPL_SEE")),
    ("GPL-2.0-or-later", ("GPL_FREE", "GPL_UNDER", "GPL2_LATER")),
    ("GPL-2.0-or-later", ("GPL2_WHOLE", "GPL_HOPE", "GPL_IMPLIED", "GPL_SEE")),
    ("GPL-2.0-or-later", ("GPL2_WHOLE",)),
    ("GPL-3.0-only", ("GPL3_NAMED",)),
    ("GPL-2.0-only", ("GPL2_NAMED",)),
    ("LGPL-2.1-or-later", ("LGPL_FREE", "LGPL21_TERMS", "LGPL_HOPE", "GPL_IMPLIED", "LGPL_SEE")),
    ("LGPL-2.1-or-later", ("LGPL_FREE", "LGPL21_TERMS")),
    ("LGPL-2.1-or-later", ("LGPL_FREE", "LGPL_UNDER", "LGPL21_LATER", "LGPL_HOPE", "GPL_IMPLIED", "LGPL_SEE")),
    ("LGPL-2.1-or-later", ("LGPL_FREE", "LGPL_UNDER", "LGPL21_LATER")),
    ("LGPL-2.1-only", ("LGPL21_NAMED",)),
    ("LGPL-3.0-only", ("LGPL3_NAMED",)),
    ("MPL-2.0", ("MPL2_NAMED",)),
    ("EPL-2.0", ("EPL2_TERMS",)),
    ("EPL-2.0", ("EPL2_NAMED",)),
    ("EPL-1.0", ("EPL1_TERMS",)),
    ("Zlib", ("ZLIB_NAMED", "ZLIB_WARRANTY", "ZLIB_LIABILITY", "ZLIB_GRANT")),
    ("Zlib", ("ZLIB_WARRANTY", "ZLIB_LIABILITY", "ZLIB_GRANT")),
    ("Zlib", ("ZLIB_NAMED",)),
    ("CC0-1.0", ("CC_CODE", "CC0_TITLE")),
    ("CC0-1.0", ("CC0_TITLE",)),
    ("CC0-1.0", ("CC0_WAIVER",)),
    ("Artistic-2.0", ("ARTISTIC2_NAMED",)),
    ("ISC", ("ISC_NAMED", "ISC_GRANT", "MIT_WARRANTY")),
    ("ISC", ("ISC_NAMED", "ISC_GRANT")),
    ("ISC", ("ISC_NAMED",)),
    ("AGPL-3.0-only", ("AGPL3_NAMED",)),
    ("CC-BY-4.0", ("CC_BY",)),
    ("CC-BY-SA-4.0", ("CC_BY_SA",)),
    ("CC-BY-NC-4.0", ("CC_BY_NC",)),
    ("CC-BY-ND-4.0", ("CC_BY_ND",)),
    ("Unlicense", ("UNLICENSE_FREE",)),
    ("MPL-2.0", ("MPL2_TERMS", "MPL2_COPY")),
    ("MPL-2.0", ("MPL2_TERMS",)),
    ("MPL-2.0", ("MPL2_COPY",)),
    ("ISC", ("ISC_GRANT", "MIT_WARRANTY")),
    ("ISC", ("ISC_GRANT",)),
    ("BSL-1.0", ("BSL1_TITLE",)),
    ("proprietary", ("ALL_RIGHTS",)),
)


def _sequence(ids: Sequence[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def _lookup(m: Mapping[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in m.items() for x in kv))


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(sentence, UPPER, LOWER), OTHER, " "))


def _pattern(sentence: str, gap: str) -> str:
    """Regular expression of a known sentence whose words are ``gap`` apart."""
    more = f"(?:{gap}[a-z0-9]+)"
    words = sentence.removesuffix(" *").split(" ")
    out = words[0] + "".join(f"{more}{{1,{SLOT}}}?" if w == "*" else gap + w for w in words[1:])
    return out + (f"{more}{{0,{REST}}}?" if sentence.endswith(" *") else "")


def _any_of(sentences: Iterable[str], gap: str) -> str:
    """One pattern for all, by first word: two that begin with different
    words can't begin at one place."""
    by_first: dict[str, list[str]] = {}
    for s in _usable(sentences):
        first = s.split(" ")[0]
        by_first.setdefault(first, []).append(_pattern(s, gap)[len(first):])
    return "|".join(f"{w}(?:{'|'.join(rest)})" for w, rest in by_first.items())


def _usable(sentences: Iterable[str]) -> list[str]:
    """Shortest first: of several that begin at one place it is taken."""
    return sorted((s for s in sentences if re.fullmatch(r"[a-z0-9]+( ([a-z0-9]+|\*))*", s)), key=lambda s: (len(s), s))


def _slotted(sentences: Iterable[str]) -> list[str]:
    return [s for s in _usable(sentences) if "*" in s]


def known_sentences(text: Column, sentences: Iterable[str]) -> Column:
    """The known sentences in a text, in order, wrapped ones included, with
    their slots as ``*``; of several that begin at one place, the shortest
    that ends at an end."""
    x = F.concat(F.lit("\n\n"), F.translate(text, UPPER, LOWER), F.lit("\n\n"))
    for pattern, mark in MARKS:
        x = F.regexp_replace(x, pattern, mark)
    any_of = _any_of(sentences, "[ L]")
    found = F.regexp_extract_all(x, F.lit(f"(?<=[HL])({any_of or '(?!)'})(?=[HL])"), F.lit(1))

    def named(s: Column) -> Column:
        s = F.translate(s, "L", " ")
        for slotted in _slotted(sentences):
            s = F.regexp_replace(s, f"^{_pattern(slotted, ' ')}$", slotted)
        return s
    return F.transform(found, named)


def scan(docs: DataFrame, sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_sentences, n_known, sentence_ids, licences, n_unclaimed)."""
    ids = _lookup(sentences)
    by_sequence = _lookup({_sequence(s): name for name, s in reversed(list(rules))})
    pattern = "|".join(_sequence(s) for _, s in rules)
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    cut = F.filter(F.transform(F.split("text", CUT), normalised), lambda s: s != "")
    known = F.transform(known_sentences(F.col("text"), sentences), lambda s: F.try_element_at(ids, s))
    x = x.select("doc_id", F.size(cut).cast("long").alias("n_sentences"), known.alias("k"))
    x = x.select("doc_id", "n_sentences", F.size("k").cast("long").alias("n_known"),
                 F.array_join(F.transform("k", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "").alias("sentence_ids"))
    claimed = F.regexp_extract_all("sentence_ids", F.lit(f"({pattern})"), F.lit(1))
    x = x.withColumn("claims", F.transform(claimed, lambda s: F.try_element_at(by_sequence, s)))
    yields = ", ".join(f"'{n}'" for n in YIELDS)
    x = x.withColumn("claims", F.expr(f"filter(claims, (x, i) -> x not in ({yields}) or forall(slice(claims, i + 1, size(claims)), y -> y in ({yields})))"))
    rest = F.regexp_replace("sentence_ids", pattern, "")
    return x.select("doc_id", "n_sentences", "n_known", "sentence_ids",
                    F.array_join(F.array_distinct("claims"), ",").alias("licences"),
                    (F.length(rest) - F.length(F.replace(rest, F.lit("<"), F.lit("")))).cast("long").alias("n_unclaimed"))


#: MARKS for an engine without look-around. A line end before a blank line is taken with it, and marks are
#: doubled at the end, so that a sentence has an end of its own on either side.
SQL_MARKS = ((r"[.;!?]([\n\r])", r"H\1"), (r"[.;!?][ \t]+", "H"), (r"(\r\n|[\n\r])([^a-zA-Z0-9\n\r]*)([\n\r])", r"H\2\3"), (r"[\n\r]+", "L"),
             (r"[^a-z0-9HL]+", " "), (r"[ HL]*H[ HL]*", "H"), (r" ?L ?", "L"), (r"([HL])", r"\1\1"))


def oracle_sql(sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, Sequence[str]]] = RULES) -> str:
    """The same scan of ``documents``, wrapped sentences included, for DuckDB."""
    def entries(m: Mapping[str, str]) -> str:
        return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in m.items()) + "}"
    by_sequence = {_sequence(s): name for name, s in reversed(list(rules))}
    pattern = "|".join(_sequence(s) for _, s in rules)
    ascii = lambda p: p.replace("\\n", "\n").replace("\\r", "\r").replace("\\t", "\t")
    marked = f"chr(10) || chr(10) || translate(coalesce(text, ''), '{UPPER}', '{LOWER}') || chr(10) || chr(10)"
    for p, mark in SQL_MARKS:
        marked = f"regexp_replace({marked}, '{ascii(p)}', '{mark}', 'g')"
    any_of = _any_of(sentences, "(?: |LL)")
    plain = "replace(x, 'LL', ' ')"
    for slotted in _slotted(sentences):
        plain = f"regexp_replace({plain}, '^{_pattern(slotted, ' ')}$', '{slotted}')"
    yields = ", ".join(f"'{n}'" for n in YIELDS)
    return f"""
WITH s AS (
  SELECT doc_id, len(list_filter(list_transform(string_split_regex(coalesce(text, ''), '{ascii(CUT)}'),
           lambda x: trim(regexp_replace(translate(x, '{UPPER}', '{LOWER}'), '{OTHER}', ' ', 'g'))), lambda x: x <> '')) AS n_sentences,
         list_transform(regexp_extract_all({marked}, '[HL]({any_of})[HL]', 1), lambda x: {plain}) AS s
  FROM documents),
k AS (
  SELECT doc_id, n_sentences, list_filter(list_transform(s, lambda x: ({entries(sentences)})[x]), lambda x: x IS NOT NULL) AS k FROM s),
j AS (
  SELECT doc_id, n_sentences, len(k) AS n_known, coalesce(array_to_string(list_transform(k, lambda x: '<' || x || '>'), ''), '') AS sentence_ids FROM k),
n AS (
  SELECT *, list_transform(regexp_extract_all(sentence_ids, '({pattern})', 1), lambda x: ({entries(by_sequence)})[x]) AS named,
         regexp_replace(sentence_ids, '{pattern}', '', 'g') AS rest FROM j),
c AS (
  SELECT *, list_filter(named, lambda x, i: x NOT IN ({yields}) OR len(list_filter(named[i + 1:], lambda y: y NOT IN ({yields}))) = 0) AS claims FROM n)
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, CAST(n_known AS BIGINT) AS n_known, sentence_ids,
       coalesce(array_to_string(list_filter(claims, lambda x, i: list_position(claims, x) = i), ','), '') AS licences,
       CAST(length(rest) - length(replace(rest, '<', '')) AS BIGINT) AS n_unclaimed
FROM c"""
