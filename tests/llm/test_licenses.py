import collections
import re

import duckdb

from revops_spark.llm import licenses as li
from revops_spark.llm._shared import table


SPDX = {**{i.lower(): i for i in li.SPDX_IDS}, **{i.lower() + "+": i for i in li.SPDX_IDS}}
for gnu in li.GNU_IDS:
    SPDX |= {gnu.lower(): gnu + "-only", gnu.lower() + "+": gnu + "-or-later",
             gnu.lower() + "-only": gnu + "-only", gnu.lower() + "-or-later": gnu + "-or-later"}


def expressions(text):
    """Licences of the SPDX expressions, read word by word."""
    out = []
    for behind in re.split(r"(?i)spdx-license-identifier:", text)[1:]:
        start = re.match(r"[\W_]*", behind).group()
        if start.count("\n") > 1:
            continue
        line = re.match(r"[A-Za-z0-9.+() \t-]*", behind[len(start):]).group()
        words, exception = re.sub(r"[()\t]", " ", line).split(), False
        while words:
            name = SPDX.get(words[0].rstrip(".-").lower())
            if name and not exception:
                out.append(name)
            if len(words) < 2 or words[1].upper() not in ("AND", "OR", "WITH"):
                break
            exception, words = words[1].upper() == "WITH", words[2:]
    return out


def brute(text):
    known = {s: i for i, s in li.SENTENCES}
    parts = re.split(r"\n+|(?<=[.!?;:])\s+", text or "")
    ids = [known[n] for p in parts
           if (n := re.sub(r"[\W_]+", " ", p.lower()).strip()) in known]

    def times(rule):
        rest, n = iter(ids), 0
        while all(x in rest for x in rule):
            n += 1
        return n

    own = {}
    for rule in sorted({r for _, r in li.RULES}, key=len, reverse=True):
        holds = [r for r in own if len(r) > len(rule) and rule in zip(*(r[i:] for i in range(len(rule))))]
        own[rule] = max(0, times(rule) - sum(own[r] for r in holds))
    spdx = expressions(text or "")
    names = sorted({name for name, rule in li.RULES if own[rule]} | set(spdx))
    return ",".join(names), len(names), len(ids) + len(spdx)


BSD2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:\nRedistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.\n")
BSD3 = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.\n")
CASES = [
    None, "", "  \n ", "nothing here", "Released under the MIT License.",
    "foo bar.  RELEASED UNDER THE -- MIT LICENSE!!\nbaz", "released under the mit license terms",
    "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.",
    "SPDX-License-Identifier: MIT", "// SPDX-License-Identifier:  Apache-2.0\ncode();",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, "
    "or (at your option) any later version.",
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:\nsome other sentence.\nRedistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following disclaimer.",
    # the same two sentences the other way round match no rule
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\nRedistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that the following conditions are met:",
    "Released under the MIT License.\n" * 3000 + "x" * 100_000,
    # BSD-3 alone, and with a BSD-2 text before it
    BSD2 + BSD3, BSD2 + BSD2 + BSD3, BSD2 + BSD3 + BSD2 + BSD3,
    "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: BSD-3-Clause */",
    "spdx-license-identifier: (MIT OR Apache-2.0) AND (lgpl-2.1+ WITH MIT)",
    "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 or ISC.", "SPDX-License-Identifier: MIT AND",
    "SPDX-License-Identifier: MIT--> BSD-3-Clause", "SPDX-License-Identifier: NoSuchLicense OR GPL-3.0+",
    "x SPDX-License-Identifier: MIT y SPDX-License-Identifier: Zlib z MIT", "SPDX-License-Identifier:",
    "SPDX-License-Identifier:\n\nMIT", "SPDX-License-Identifier:" + "-" * 100_000 + "\n" + "-" * 100_000 + "(MIT",
    "SPDX-License-Identifier: MIT" + " OR MIT" * 5_000 + " " * 50_000 + "." * 50_000 + "x",
]


def result(df):
    return {r.doc_id: (r.licenses, r.n_licenses, r.n_sentences) for r in df.collect()}


def test_cases_match_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = result(li.scan(df))
    assert got == {i: brute(t) for i, t in enumerate(CASES)}
    assert got[10][0] == "GPL-3.0-or-later" and got[11][0] == "BSD-2-Clause" and got[12][0] == ""
    assert got[13] == ("MIT", 1, 3000)
    assert [got[i][0] for i in range(14, 29)] == [
        "BSD-3-Clause", "BSD-2-Clause,BSD-3-Clause", "BSD-3-Clause", "GPL-2.0-or-later", "BSD-3-Clause",
        "Apache-2.0,LGPL-2.1-or-later,MIT", "GPL-2.0-only,ISC", "MIT", "MIT", "GPL-3.0-or-later", "MIT,Zlib", "",
        "", "MIT", "MIT"]


def test_odd_documents(odd, odd_docs, no_docs):
    got = collections.Counter(tuple(r) for r in li.scan(odd_docs).collect())
    assert got == collections.Counter((i, *brute(t)) for i, t, *_ in odd)
    assert li.scan(no_docs).collect() == []


def test_matches_the_oracle(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet')")
    want = {r[0]: r[1:] for r in con.execute(li.oracle_sql()).fetchall()}
    got = result(li.scan(table(spark, d, "documents")))
    assert got == want and len({v[0] for v in got.values()}) > 3


def test_the_oracle_on_the_cases(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(x) for x in enumerate(CASES)])
    assert {r[0]: r[1:] for r in con.execute(li.oracle_sql()).fetchall()} == {
        i: brute(t) for i, t in enumerate(CASES)}


def test_own_tables(spark):
    df = spark.createDataFrame([(1, "Alpha one. Beta two. Alpha one. Gamma")], "doc_id long, text string")
    got = li.scan(df, sentences=[(1, "alpha one"), (2, "beta two"), (3, "gamma")],
                  rules=[("forward", (1, 2, 1)), ("backward", (3, 2)), ("twice", (1, 1))])
    assert result(got) == {1: ("forward,twice", 2, 4)}


NOTICES = {
    "MIT": [
        """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
""", "Released under\nthe MIT License.", "Licensed under the\r\nMIT License.",
        "SPDX-License-Identifier:\n MIT"],
    "Apache-2.0": [
        """Licensed under the Apache License, Version 2.0 (the
"License"); you may not use this file except in
compliance with the License. You may obtain a copy
of the License at
    http://www.apache.org/licenses/LICENSE-2.0""",
        "Licensed under the Apache\nLicense, Version 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "BSD-2-Clause": [BSD := """Copyright (c) 2020, Some Body
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""],
    "BSD-3-Clause": [BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""],
    "GPL-3.0-or-later": [GPL := """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""],
    "GPL-2.0-or-later": [GPL.replace("3", "2").replace("software:", "software;"),
                         """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.
"""],
    "GPL-2.0-only": ["""This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License version 2 as
published by the Free Software Foundation.
""", "Licensed under the GNU General Public\nLicense v2.0."],
    "LGPL-2.1-or-later": ["""This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
""", "SPDX-License-Identifier: LGPL-2.1+"],
    "LGPL-3.0-or-later": [GPL.replace("GNU General", "GNU Lesser General")],
    "LGPL-3.0-only": ["This software is released under the GNU Lesser\nGeneral Public License version 3."],
    "AGPL-3.0-or-later": [GPL.replace("GNU General", "GNU Affero General")],
    "AGPL-3.0-only": ["This project is licensed under the GNU Affero General\nPublic License v3.0."],
    "ISC": ["""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""", """Permission to use, copy, modify, and distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""],
    "CC0-1.0": ["CC0 1.0 Universal\n\nCREATIVE COMMONS CORPORATION IS NOT A LAW FIRM", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense": ["""This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""],
    "EPL-2.0": ["""This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/

SPDX-License-Identifier: EPL-2.0
"""],
    "Zlib": ["""Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""],
    "BSL-1.0": ["""Distributed under the Boost Software License, Version 1.0.
   (See accompanying file LICENSE_1_0.txt)
"""],
    "GPL-3.0-only": ["This work is licensed under the GNU General\nPublic License version 3.",
                     "SPDX-License-Identifier: GPL-3.0-only"],
    "CC-BY-4.0": ["Licensed under\nCC BY 4.0", "This work is licensed under a Creative Commons\n"
                  "Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under\nCC BY-NC 4.0"],
    "CC-BY-SA-4.0": ["Licensed under\nCC BY-SA 4.0"],
    "MPL-2.0": ["""This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
""", "This Source Code Form is subject to the terms of the Mozilla Public License, v.\n2.0."],
}


def test_wrapped_standard_texts_of_every_rule(spark):
    assert {n for names in NOTICES for n in names.split(",")} == {name for name, _ in li.RULES}
    marks = [("", "", ""), ("/*\n", " * ", "\n */"), ("", "# ", ""), ("", "// ", ""), ("<!--\n", "  ", "-->")]
    rows, want = [], []
    for names, texts in NOTICES.items():
        for text in texts:
            for before, mark, after in marks:
                body = "\n".join((mark + line).rstrip() for line in text.split("\n"))
                rows.append((len(rows), f"{before}{body}{after}\ncode();\n"))
                want.append(names)
    got = result(li.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [(i, got[i][0]) for i in got if got[i][0] != want[i]] == []


def test_sentences_are_not_joined_over_ends(spark):
    texts = ["Released under\n\nthe MIT License", "# Released under\n#\n# the MIT License",
             "Released under.\nThe MIT License", "Released under\x02the MIT License",
             "Released under the MIT License v. 2", "Released under\nthe MIT License terms",
             "Licensed under the Apache License, Version 2.0\nthe License",
             " " * 50_000 + "-\n" * 50_000 + "x" + "-" * 100_000]
    got = result(li.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [got[i] for i in range(len(texts))] == [
        ("", 0, 0), ("", 0, 0), ("", 0, 0), ("MIT", 1, 1), ("", 0, 0), ("", 0, 0),
        ("Apache-2.0", 1, 2), ("", 0, 0)]


def test_plan_is_native_and_narrow(spark):
    plan = li.scan(table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange", "Join"))
