import re
import textwrap

import duckdb
import pytest

import __spark_entry__ as E
from ledgerflow.llm import licences as lic
from tests.conftest import SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs, odd_texts

MIT = """Copyright (c) 2020 Someone. MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. More.
Licensed under the Apache License, Version 2.0."""


def slow_scan(text):
    text = text or ""
    s = [re.sub("[^a-z0-9]+", " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in x)).strip(" ") for x in re.split(r"[\n\r]+|[.;!?][ \t]+", text)]
    s = [x for x in s if x]
    ids = [lic.SENTENCES[x] for x in s if x in lic.SENTENCES]
    named, at, rest = [], 0, 0
    while at < len(ids):
        for name, rule in lic.RULES:
            if tuple(ids[at:at + len(rule)]) == tuple(rule):
                named.append(name)
                at += len(rule)
                break
        else:
            rest, at = rest + 1, at + 1
    named = [n for i, n in enumerate(named) if n != "proprietary" or set(named[i:]) == {"proprietary"}]
    return len(s), len(ids), "".join(f"<{i}>" for i in ids), ",".join(dict.fromkeys(named)), rest


def as_tuple(r):
    return (r.n_sentences, r.n_known, r.sentence_ids, r.licences, r.n_unclaimed)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    cur = con.execute(E.oracle_sql()["op4_licences"])
    names = [d[0] for d in cur.description]
    want = sorted(tuple(dict(zip(names, r))[n] for n in sorted(names)) for r in cur.fetchall())
    df = E.queries()["op4_licences"](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r[n] for n in sorted(names)) for r in df.collect()) == want


def test_plan_has_no_python_and_no_shuffle(spark):
    plan = E.queries()["op4_licences"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_sequences_and_rule_order(spark):
    texts = [MIT, "Released under the MIT License.", "All rights reserved. Licensed under CC BY-NC 4.0.",
             "See the License for the specific language governing permissions and limitations under the License.", "Licensed under CC BY-NC 4.0. " * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lic.scan(df).collect()}
    assert [got[i].licences for i in range(5)] == ["MIT,Apache-2.0", "MIT", "CC-BY-NC-4.0", "", "CC-BY-NC-4.0"]
    assert got[3].n_unclaimed == 1 and got[0].sentence_ids.startswith("<MIT_TITLE><MIT_GRANT><MIT_NOTICE><MIT_WARRANTY>")
    assert all(as_tuple(got[i]) == slow_scan(t) for i, t in enumerate(texts))


def test_odd_rows(spark):
    df = odd_docs(spark)
    want = sorted((r.doc_id is None, r.doc_id or 0, slow_scan(r.text)) for r in df.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, as_tuple(r)) for r in lic.scan(df).collect()) == want


def test_empty_table(spark):
    assert lic.scan(empty_docs(spark)).collect() == []


def test_known_sentences_are_normalised_and_rules_use_them():
    assert all(re.fullmatch(r"[a-z0-9]+( ([a-z0-9]+|\*))*", s) for s in lic.SENTENCES)
    assert {i for _, r in lic.RULES for i in r} <= set(lic.SENTENCES.values())


@pytest.mark.parametrize("rule", lic.RULES[:3])
def test_own_tables(spark, rule):
    df = spark.createDataFrame([(1, "Foo bar.\nBaz; qux!")], "doc_id long, text string")
    (r,) = lic.scan(df, {"foo bar": "A", "baz": "B"}, [("both", ("A", "B")), ("one", ("A",))]).collect()
    assert r.licences == "both" and r.n_sentences == 3


GRANTS = {
    "MIT": [MIT.split("\n")[2], MIT.split("\n")[3], MIT.split("\n")[4].removesuffix(" More.")],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
                     "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
                     "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
                     "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
                     'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "GPL-3.0-or-later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
                         "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details."],
}


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_licences(spark, mark, end):
    blank = end + mark.rstrip() + end
    want, texts = [], []
    for name, parts in GRANTS.items():
        for width in (40, 72, 80):
            want.append(name)
            texts.append(blank.join(end.join(mark + x for x in textwrap.wrap(p, width)) for p in parts))
    rows = lic.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.licences for r in sorted(rows, key=lambda r: r.doc_id)] == want
    assert all(r.n_unclaimed == 0 for r in rows)


def test_wrapping_stops_at_ends_and_blank_lines(spark):
    texts = ["released under\nthe MIT\nLicense", "released under\n\nthe big license", "released under.\nthe MIT license", "released under\n--\nthe MIT license",
             "All rights reserved\nlicensed under CC BY 4.0\nby us", "\r\n\r\nMIT License\r\nMIT License", "un\nreleased under the MIT license\n" * 3, "\n" * 50_000 + "MIT\nlicense"]
    rows = lic.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = [r.sentence_ids for r in sorted(rows, key=lambda r: r.doc_id)]
    assert got == ["<MIT_NAMED>", "", "<MIT_TITLE>", "<MIT_TITLE>", "<ALL_RIGHTS><CC_BY>", "<MIT_TITLE><MIT_TITLE>", "<MIT_NAMED>" * 3, "<MIT_TITLE>"]


BSD_WARRANTY = GRANTS["BSD-3-Clause"][4]
GPL_REST = """
This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
NOTICES = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
""" + GPL_REST),
    ("GPL-2.0-or-later", """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
""" + GPL_REST),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization"),
    ("BSL-1.0", "// Distributed under the Boost Software License, Version 1.0.\n//    (See accompanying file LICENSE_1_0.txt or copy at\n//          https://www.boost.org/LICENSE_1_0.txt)"),
    ("BSD-4-Clause", "\n".join([*GRANTS["BSD-3-Clause"][:3], """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by the organization.
4. """ + GRANTS["BSD-3-Clause"][3][3:]])),
    ("BSD-3-Clause", "Copyright (c) 2019, Someone Else\nAll rights reserved.\n\n" + "\n".join(GRANTS["BSD-3-Clause"])),
    ("BSD-3-Clause", "\n\n".join([*GRANTS["BSD-3-Clause"][:3], "3. Neither the name of the Foo Bar Foundation nor the names of its\n   contributors may be used to endorse or promote "
                                    "products derived from\n   this software without specific prior written permission.",
                                    BSD_WARRANTY.replace("COPYRIGHT HOLDERS AND CONTRIBUTORS", "REGENTS AND CONTRIBUTORS")])),
    ("MIT", "// SPDX-License-Identifier: MIT\nint x;"), ("GPL-2.0-or-later", "# SPDX-License-Identifier: GPL-2.0-or-later"),
    ("MIT", "This project is licensed under the MIT License - see the\n[LICENSE](LICENSE) file for details."),
    ("LGPL-2.1-or-later", """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""),
    ("EPL-2.0", """This program and the accompanying materials are made available under the
terms of the Eclipse Public License 2.0 which is available at
http://www.eclipse.org/legal/epl-2.0.
"""),
    ("Zlib", """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""),
    ("CC0-1.0", "Creative Commons Legal Code\n\nCC0 1.0 Universal\n"),
    ("CC0-1.0", "To the extent possible under law, Some Author has waived all copyright\nand related or neighboring rights to This Work."),
    ("proprietary", "Copyright 2001 Big Corp. All rights reserved.\nNo part may be copied."),
    ("MIT,proprietary", "Released under the MIT License.\nThe logo is ours. All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.\n"),
]


def test_public_notices_as_they_are_published(spark):
    rows = lic.scan(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(NOTICES)], "doc_id long, text string")).collect()
    rows.sort(key=lambda r: r.doc_id)
    assert [(r.licences, r.n_unclaimed) for r in rows] == [(name, 0) for name, _ in NOTICES]


def test_sql_holds_wrapped_texts_to_the_same_contract(spark):
    """Every notice, wrapped, marked and among odd texts, in Spark and in DuckDB."""
    texts = [t for _, t in NOTICES] + odd_texts() + ["a.\n.\nb", "un.  \n\nMIT License", "x\n--\n--\nMIT License!\r\n\r\nzlib license;", "all rights\nreserved"]
    for width in (30, 72):
        texts += ["\n".join(mark + x for p in t.split("\n\n") for x in [*textwrap.wrap(p, width), ""]) for mark in ("", "# ", " * ") for _, t in NOTICES]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = ["doc_id", "n_sentences", "n_known", "sentence_ids", "licences", "n_unclaimed"]
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({lic.oracle_sql()})").fetchall())
    assert sorted(tuple(r[n] for n in names) for r in lic.scan(df).collect()) == want
