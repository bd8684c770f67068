import re

from gleanery.llm import licenses as m
from gleanery.llm.secrets_scan import trigram_query
from tests.llm.fixtures import docs, save, words

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

CASES = [
    "", None, "no such thing", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "UNDER-the (mit) LICENSE under the MIT licenses", "under the mit license under the mit license cc-by-nc-sa cc.by.nc",
    "Licensed under the Apache License, Version 2.0", "apache license version 20", "Apache_License\nVersion\t2", "xcc by nc", "écc by nc", "cc by nc cc by nc", "under the MİT license",
    "This work is licensed under the GNU General Public License, version 3.", "GNU Lesser General Public License v2.1 or later", "SPDX-License-Identifier: GPL-2.0-or-later", "All rights reserved.", "mit license",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. http://www.apache.org/licenses/LICENSE-2.0",
]


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    """Base places by comparing words; all rules without their keywords; containment pair by pair."""
    ws = split(text)
    base = sorted((i, label) for p, label in PHRASES.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split())
    joined = f" {' '.join(ws)} "
    found = [(joined[: x.start()].count(" ") - 1, joined[: x.end()].count(" ") - 1 + 1, i) for i, r in enumerate(m.RULES) for x in re.finditer(f"(?<= )(?:{r.pattern})(?= )", joined)]
    rank = lambda d: (m.RULES[d[2]].priority, d[0] - d[1], d[2])
    kept = [d for d in found if m.RULES[d[2]].kind == "base" or not any(e != d and e[0] <= d[0] and d[1] <= e[1] and rank(e) < rank(d) for e in found)]
    return ws, base, kept


def test_against_brute_force(spark, tmp_path):
    long = words(3, 30_000)
    rows = [*enumerate(CASES), (None, CASES[3]), (3, CASES[3]), (3, CASES[3]), (90, f"{long} under the MIT license {long} cc by nc {'mit license ' * 500}")]
    got = m.op11(spark, save(docs(spark, rows, clash=True), tmp_path, "documents")).collect()
    assert len(got) == len(rows)
    want = []
    for i, t in rows:
        ws, base, kept = brute(t)
        labels = {m.RULES[d[2]].label for d in kept}
        want.append((i, len(ws), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), max((m.KINDS[m.RULES[d[2]].kind] for d in kept), default=0.0), len(kept)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert all(0 <= r.score <= 1 and {*filter(None, r.base_labels.split(","))} <= {*r.labels.split(",")} for r in got)


def labels_of(text):
    s = m.Scanner()
    return {(m.RULES[i].label, m.RULES[i].kind) for _, _, i in s.kept(s.detections(m.words_of(text)))}


def test_suppression():
    assert labels_of("the GNU Lesser General Public License, v2.1") == {("lgpl-2", "name")}
    assert ("gpl-3", "notice") in labels_of(CASES[14]) and not any(x == "gpl" for x, _ in labels_of(CASES[14]))
    assert labels_of("CC BY-NC-SA 4.0") == {("cc-by-nc-sa", "name"), ("cc-by-nc", "base")}
    assert labels_of("SPDX-License-Identifier: Apache-2.0") == {("apache-2", "tag")}
    # An equal interval of a lesser kind goes; intervals that only overlap both stay.
    a, b, c = (m.Rule(x, k, "aa", p) for x, k, p in (("x", "name", "aa bb"), ("y", "notice", "aa bb"), ("z", "hint", "bb cc")))
    s = m.Scanner((a, b, c))
    assert s.kept(s.detections(["aa", "bb", "cc"])) == [(0, 2, 1), (1, 3, 2)]


def test_keywords_are_mandatory():
    assert len(m.RULES) > 250
    for r in m.RULES:
        if len(r.keyword) < 3:
            assert r.keyword in re.sub(r"\(\?:.*?\)\?", "", r.pattern), r
            continue
        grams = {r.keyword[i : i + 3] for i in range(len(r.keyword) - 2)}
        assert all(grams <= c for c in trigram_query(r.pattern) or ({},)), r


def test_empty_table(spark):
    assert m.scan_licenses(docs(spark, [])).count() == 0
