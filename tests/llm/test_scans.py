import random

from helpers import EDGES, table

from marquee.llm import decontam, licences


def test_licences_in_order(spark):
    apache = ("Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License.\n"
              "You may obtain a copy of the License at:\nSee the License for the specific language governing permissions and "
              "limitations under the License.")
    rows = [(1, apache), (2, "Text. Licensed under the Apache License, Version 2.0.\nmore"), (3, "Released under  the MIT License!!\n"
            "Released under the MIT license."), (4, "Licensed under CC BY-NC 4.0"), (5, "the mit license is short"),
            (6, "See the license for the specific language governing permissions and limitations under the license."),
            (7, "x " * 30_000 + ". All rights reserved.")]
    got = sorted(map(tuple, licences.find_licences(table(spark, rows)).collect()))
    assert got == [(1, "Apache-2.0", 1), (2, "Apache-2.0", 1), (3, "MIT", 2), (4, "CC-BY-NC-4.0", 1), (7, "All-Rights-Reserved", 1)]


def plain_licences(sequence):
    out = {}
    for name, rule in licences.RULES:
        n = sequence.count(rule)
        sequence = sequence.replace(rule, "-")
        out[name] = out.get(name, 0) + n
    return {k: v for k, v in out.items() if v}


def test_licence_rules_against_plain(spark):
    rng = random.Random(3)
    texts = dict(licences.SENTENCES)
    rows, want = [], set()
    for i in range(120):
        own = "".join(rng.choice("ABCDEFGHPQRSVJKL") for _ in range(rng.randrange(1, 9))) + rng.choice(["", "ABCD", "QRS", "VG"])
        rows.append((i, "\n".join(("noise here.\n" if rng.random() < .3 else "") + texts[x].upper() + "." for x in own)))
        want |= {(i, k, v) for k, v in plain_licences(own).items()}
    assert set(map(tuple, licences.find_licences(table(spark, rows)).collect())) == want


def test_licence_edges(spark):
    rows = [*EDGES, (40, "All rights reserved."), (40, "All rights reserved."), (None, "All rights reserved")]
    df = table(spark, rows, extra=("place", "sentence", "s0", "licence"))
    assert sorted(map(str, map(tuple, licences.find_licences(df).collect()))) == sorted(
        map(str, [(40, "All-Rights-Reserved", 1), (None, "All-Rights-Reserved", 1)]))
    assert licences.find_licences(table(spark, [])).collect() == []


APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
ASF = """Licensed to the Apache Software Foundation (ASF) under one or more
contributor license agreements.  See the NOTICE file distributed with
this work for additional information regarding copyright ownership.
The ASF licenses this file to You under the Apache License, Version 2.0
(the "License"); you may not use this file except in compliance with
the License.  You may obtain a copy of the License at

   http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2020 Some One

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
SOFTWARE.
"""
BSD2 = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
CC = """This work is licensed under a Creative Commons
Attribution-ShareAlike 4.0 International License.
"""


def test_wrapped_notices(spark):
    notices = [(APACHE, "Apache-2.0"), (ASF, "Apache-2.0"), (MIT, "MIT"), (BSD2, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"),
               (GPL, "GPL-3.0-or-later"), (GPL.replace("version 3", "version 2"), "GPL-2.0-or-later"), (MPL, "MPL-2.0"),
               (CC, "CC-BY-SA-4.0")]
    shapes = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: t.replace("\n", "\r"),
              lambda t: "".join(f"# {x}".rstrip() + "\n" for x in t.splitlines()) + "import os\n",
              lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.splitlines()) + " */\nint x;\n",
              lambda t: "".join(f"// {x}\n" for x in t.splitlines()),
              lambda t: "Some words before it\n" + t + "and after it\n",
              lambda t: "\n\n".join(" ".join(x.split("\n")) for x in t.split("\n\n"))]
    rows, want = [], []
    for n, (text, name) in enumerate(notices):
        for k, shape in enumerate(shapes):
            rows.append((100 * n + k, shape(text)))
            want.append((100 * n + k, name, 1))
    assert sorted(map(tuple, licences.find_licences(table(spark, rows)).collect())) == want


def test_sentences_end(spark):
    rows = [(1, "Released under\n\nthe MIT License."), (2, "It was released under. The MIT License"), (3, "Released under. The MIT License."),
            (4, "not released under\nthe MIT License"), (5, "Released under\nthe MIT License\u0001 of old"),
            (6, "Released under\n * the MIT\n * License."), (7, "\u0002Released under the MIT License")]
    assert sorted(map(tuple, licences.find_licences(table(spark, rows)).collect())) == [(6, "MIT", 1), (7, "MIT", 1)]


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


QUESTION = "If Alice has 12 apples and gives 5 apples to Bob then how many apples does Alice still have after 12 days"


def leaks(spark, docs, items, **options):
    return sorted((r["doc_id"], r["item_id"], r["verbatim"]) for r in
                  decontam.find_leaks(table(spark, docs), benchmark(spark, items), **options).collect())


def test_parameters_and_consistency(spark):
    docs = [(1, "before. " + QUESTION + "? after"), (2, QUESTION.upper()),
            (3, QUESTION.replace("Alice", "Carol").replace("12", "30").replace("Bob", "Dave")),
            (4, QUESTION.replace("Alice has 12", "Carol has 30")), (5, "nothing of the kind in this document at all, is there"),
            (6, "If Alice has 12 apples")]
    got = leaks(spark, docs, [(7, QUESTION)])
    assert (1, 7, True) in got and (2, 7, True) in got and (3, 7, False) in got
    assert not [r for r in got if r[0] in (5, 6)]


def test_inconsistent_slots_do_not_match(spark):
    item = "Anna met 10 people and then Anna saw 20 birds"
    assert leaks(spark, [(1, "Berta met 30 people and then Berta saw 40 birds")], [(1, item)]) == [(1, 1, False)]
    assert leaks(spark, [(1, "Berta met 30 people and then Clara saw 40 birds")], [(1, item)], window=10) == []
    assert leaks(spark, [(1, "Berta met 30 people and then Berta saw 30 birds")], [(1, item)], window=10) == []


def test_numbers_and_units(spark):
    item = "a car goes 1,500.5 km in 3 hours on the long road"
    assert leaks(spark, [(1, "a car goes 7 miles in 2 minutes on the long road")], [(1, item)]) == [(1, 1, False)]


def test_literal_windows_against_plain(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(30)] + ["é", "ßx"]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, text(rng.randrange(4, 25))) for i in range(20)]
    docs = []
    for i in range(60):
        own = text(rng.randrange(40))
        if rng.random() < .5:
            item = rng.choice(items)[1]
            a = rng.randrange(len(item))
            own[5:5] = item[a:a + rng.randrange(1, 14)]
        docs.append((i, own))
    grams = lambda w: {tuple(w[k:k + 8]) for k in range(max(len(w) - 7, 1))}
    want = [(i, j, True) for i, w in docs for j, v in items if grams(w) & grams(v)]
    assert leaks(spark, [(i, ", ".join(w)) for i, w in docs], [(j, " ".join(v)) for j, v in items]) == sorted(want)


def test_leak_edges(spark):
    items = [(1, None), (2, ""), (3, "one"), (None, "same lines here and then some more words"), (4, "same lines here")]
    df = table(spark, EDGES, extra=("hash", "slots", "item_id", "place"))
    got = decontam.find_leaks(df, benchmark(spark, items)).collect()
    assert got == []  # three words are no evidence
    assert leaks(spark, [], [(1, QUESTION)]) == [] and leaks(spark, [(1, QUESTION)], []) == []
    assert leaks(spark, [(1, "zero one two three"), (2, "zero one two three."), (3, "zero one two")], [(1, "Zero one, two three")]) == \
        [(1, 1, True), (2, 1, True)]


def test_common_passage(spark):
    docs = [(i, f"own{i} text " + QUESTION + f" end{i}") for i in range(200)]
    assert len(leaks(spark, docs, [(1, QUESTION), (2, "other words that nobody has written down anywhere yet")])) == 200


def test_short_items_inside_documents(spark):
    lead, tail = " ".join(f"lead{i}x" for i in range(40)), " ".join(f"tail{i}x" for i in range(40))
    four, five, seven = "zero one two three", "boil 3 eggs for dinner", "the river runs past seven old mills"
    docs = [(1, f"{lead} {five}. {tail}"), (2, f"{lead}, {four}"), (3, f"{seven} {tail}"), (4, f"{lead} boil 20 eggs for dinner {tail}"),
            (5, f"{lead} zero one two {tail}"), (6, f"{lead} the river runs past seven old barns {tail}"), (7, five), (8, "one two three")]
    items = [(1, four), (2, five), (3, seven), (4, "one two three"), (5, QUESTION)]
    assert leaks(spark, docs, items) == [(1, 2, True), (2, 1, True), (3, 3, True), (4, 2, False), (7, 2, True)]


def test_short_items_against_plain(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(6)]
    items = [(j, [rng.choice(words) for _ in range(rng.randrange(1, 12))]) for j in range(30)]
    docs = [(i, [rng.choice(words) for _ in range(rng.randrange(60))]) for i in range(60)]

    def has(w, v):
        n = min(len(v), 8)
        own = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
        return n >= 4 and any(tuple(v[k:k + n]) in own for k in range(len(v) - n + 1))
    want = [(i, j, True) for i, w in docs for j, v in items if has(w, v)]
    assert leaks(spark, [(i, " ".join(w)) for i, w in docs], [(j, " ".join(v)) for j, v in items]) == sorted(want)
