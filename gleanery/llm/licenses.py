"""License scans: ordered signature rules over a text's words, behind a keyword prefilter.

A text's words, joined by single blanks, are searched by the rules whose keyword it holds.
Every match is a detection, an interval of words. One that lies within another's interval
is suppressed if that other comes of a kind of more weight, or of the same kind and is longer;
so "gnu general public license" says nothing within "gnu lesser general public license". The
base phrases are never suppressed.

The prefilter runs on Spark's side: only texts that hold some keyword reach Python at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import table, text_or_empty

#: Kinds of rules in the order in which they prevail, and how sure a detection of each is.
KINDS = {"base": 0.95, "tag": 1.0, "notice": 0.95, "name": 0.8, "address": 0.7, "hint": 0.3}
BASE = (("mit", "mit", "under the mit license"), ("apache-2", "apache", "apache license version 2"), ("cc-by-nc", "cc", "cc by nc"))

V = r"(?: version| v| ver)?"  # before a number, which may have a "v" of its own
GNU = r"(?:the )?(?:gnu )?"
ONLY = r"(?: only| or(?: \(?at your option)? (?:any )?later(?: version)?)?"
# label: keyword, the words of its identifier, regexes of notices, of names and of addresses. A "~" in a
# column stands for the keyword of that rule where it is another than the row's.
SIGNATURES: dict[str, tuple[str, str, list[str], list[str], list[str]]] = {
    "mit": ("mit", "mit", [r"(?:licensed|released|available|distributed|published) under (?:the )?(?:terms of the )?mit(?: expat)? licen[cs]e", r"permitted under the mit licen[cs]e", "permission~permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"], [r"(?:the )?mit licen[cs]e", r"mit x11 licen[cs]e", "expat~expat licen[cs]e"], [r"opensource org licenses? mit", "choosealicense~choosealicense com licenses mit"]),
    "mit-0": ("mit", "mit 0", [r"licensed under mit 0"], [r"mit no attribution(?: licen[cs]e)?"], [r"opensource org licenses? mit 0"]),
    "x11": ("x11", "x11", [r"licensed under the x11 licen[cs]e"], [r"(?:the )?x11 licen[cs]e"], []),
    "isc": ("isc", "isc", [r"(?:licensed|released) under (?:the )?isc licen[cs]e", "permission~permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"], [r"(?:the )?isc licen[cs]e"], [r"opensource org licenses? isc"]),
    "apache-2": ("apache", "apache 2 0", [r"licensed under (?:the )?apache licen[cs]e" + V + r" 2(?: 0)?", r"(?:released|available|distributed) under (?:the )?apache(?: licen[cs]e)?" + V + r" 2(?: 0)?", r"you may not use this file except in compliance with the licen[cs]e .{0,80}?apache"], [r"(?:the )?apache(?: software)? licen[cs]e" + V + r" 2(?: 0)?", r"apache 2(?: 0)? licen[cs]e", "asl~asl 2 0"], [r"apache org licenses? licen[cs]e 2 0(?: txt| html)?", r"opensource org licenses? apache 2 0"]),
    "apache-1": ("apache", "apache 1 [01]", [r"licensed under (?:the )?apache(?: software)? licen[cs]e" + V + r" 1 [01]"], [r"apache(?: software)? licen[cs]e" + V + r" 1 [01]"], [r"apache org licenses? licen[cs]e 1 [01]"]),
    "apache": ("apache", "apache", [r"(?:licensed|released) under (?:the )?apache licen[cs]e"], [r"(?:the )?apache(?: software)? licen[cs]e"], [r"apache org licenses?"]),
    "bsd-2": ("bsd", "bsd 2 clause", [r"(?:licensed|released) under (?:the )?(?:simplified|freebsd|2 clause|two clause) bsd licen[cs]e"], [r"(?:simplified|freebsd|2 clause|two clause) bsd(?: licen[cs]e)?", r"bsd (?:2|two) clause(?: licen[cs]e)?"], [r"opensource org licenses? bsd 2 clause"]),
    "bsd-3": ("bsd", "bsd 3 clause", [r"(?:licensed|released) under (?:the )?(?:new|modified|revised|3 clause|three clause) bsd licen[cs]e", "endorse~neither the name of .{0,80}? may be used to endorse or promote products derived from this software"], [r"(?:new|modified|revised|3 clause|three clause) bsd(?: licen[cs]e)?", r"bsd (?:3|three) clause(?: licen[cs]e)?"], [r"opensource org licenses? bsd 3 clause"]),
    "bsd-4": ("bsd", "bsd 4 clause", ["acknowledgement~all advertising materials mentioning features or use of this software must display the following acknowledgement"], [r"(?:original|4 clause|four clause) bsd(?: licen[cs]e)?", r"bsd (?:4|four) clause(?: licen[cs]e)?"], []),
    "bsd-0": ("bsd", "0bsd", [], [r"(?:zero|0) clause bsd(?: licen[cs]e)?", r"0bsd(?: licen[cs]e)?"], [r"opensource org licenses? 0bsd"]),
    "bsd": ("bsd", "bsd", [r"(?:licensed|released|available) under (?:the )?bsd(?: style)? licen[cs]e", "redistribution~redistribution and use in source and binary forms with or without modification are permitted"], [r"(?:the )?bsd(?: style)? licen[cs]e"], [r"opensource org licenses? bsd license"]),
    "gpl-1": ("general", "gpl 1 0" + ONLY, [], [GNU + r"general public licen[cs]e" + V + " 1(?: 0)?" + ONLY, "gpl~gpl ?v?1(?: 0)?" + ONLY], []),
    "gpl-2": ("general", "gpl 2 0" + ONLY, [r"(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[cs]e" + V + " 2(?: 0)?" + ONLY, r"terms of the gnu general public licen[cs]e as published by the free software foundation either version 2"], [GNU + r"general public licen[cs]e(?: gpl)?" + V + " 2(?: 0)?" + ONLY, "gpl~(?:gnu )?gpl ?(?:v|version )?2(?: 0)?" + ONLY], ["gpl~gnu org licenses? (?:old licenses )?gpl 2 0", "gpl~opensource org licenses? gpl 2 0"]),
    "gpl-3": ("general", "gpl 3 0" + ONLY, [r"(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[cs]e" + V + " 3(?: 0)?" + ONLY, r"terms of the gnu general public licen[cs]e as published by the free software foundation either version 3"], [GNU + r"general public licen[cs]e(?: gpl)?" + V + " 3(?: 0)?" + ONLY, "gpl~(?:gnu )?gpl ?(?:v|version )?3(?: 0)?" + ONLY], ["gpl~gnu org licenses? gpl 3 0", "gpl~opensource org licenses? gpl 3 0"]),
    "gpl": ("general", "gpl", [r"(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?gnu general public licen[cs]e"], [GNU + r"general public licen[cs]e", "gpl~gnu gpl", "gpl~gpl licen[cs]ed?"], ["gpl~gnu org (?:licenses?|copyleft) gpl"]),
    "lgpl-2": ("lesser", "lgpl 2 [01]" + ONLY, [], [GNU + r"lesser general public licen[cs]e" + V + " 2(?: [01])?" + ONLY, "library~" + GNU + r"library general public licen[cs]e" + V + " 2(?: 0)?" + ONLY, "lgpl~(?:gnu )?lgpl ?v?2(?: [01])?" + ONLY], ["lgpl~gnu org licenses? (?:old licenses )?lgpl 2 [01]"]),
    "lgpl-3": ("lesser", "lgpl 3 0" + ONLY, [], [GNU + r"lesser general public licen[cs]e" + V + " 3(?: 0)?" + ONLY, "lgpl~(?:gnu )?lgpl ?v?3(?: 0)?" + ONLY], ["lgpl~gnu org licenses? lgpl 3 0"]),
    "lgpl": ("lesser", "lgpl", [r"(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?gnu lesser general public licen[cs]e"], [GNU + r"lesser general public licen[cs]e", "library~" + GNU + "library general public licen[cs]e", "lgpl~gnu lgpl", "lgpl~lgpl licen[cs]ed?"], ["lgpl~gnu org (?:licenses?|copyleft) lgpl"]),
    "agpl-3": ("affero", "agpl 3 0" + ONLY, [r"terms of the gnu affero general public licen[cs]e as published by the free software foundation"], [GNU + r"affero general public licen[cs]e" + V + " 3(?: 0)?" + ONLY, "agpl~(?:gnu )?agpl ?v?3(?: 0)?" + ONLY], ["agpl~gnu org licenses? agpl(?: 3 0)?"]),
    "agpl": ("affero", "agpl", [], [GNU + r"affero general public licen[cs]e", "agpl~gnu agpl"], []),
    "gfdl": ("gfdl", "gfdl 1 [123]" + ONLY, ["documentation~under the terms of the gnu free documentation licen[cs]e"], ["documentation~(?:the )?gnu free documentation licen[cs]e(?:" + V + " 1 [123])?", "gfdl", "fdl~gnu fdl"], ["fdl~gnu org (?:licenses?|copyleft) fdl(?: 1 [123])?"]),
    "mpl-1": ("mozilla", "mpl 1 [01]", [], [r"mozilla public licen[cs]e" + V + " 1 [01]", "mpl~mpl 1 [01]"], [r"mozilla org mpl mpl 1 [01]"]),
    "mpl-2": ("mozilla", "mpl 2 0", [r"subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0"], [r"mozilla public licen[cs]e" + V + " 2(?: 0)?", "mpl~mpl 2 0|mplv2"], [r"mozilla org mpl 2 0", r"mozilla org en us mpl 2 0"]),
    "mpl": ("mozilla", "mpl", [], [r"mozilla public licen[cs]e"], [r"mozilla org mpl"]),
    "epl-1": ("eclipse", "epl 1 0", [], [r"eclipse public licen[cs]e" + V + " 1(?: 0)?", "epl~epl 1 0"], [r"eclipse org legal epl v10"]),
    "epl-2": ("eclipse", "epl 2 0", [r"made available under the terms of the eclipse public licen[cs]e 2 0"], [r"eclipse public licen[cs]e" + V + " 2(?: 0)?", "epl~epl 2 0"], [r"eclipse org legal epl (?:v20|2 0)"]),
    "epl": ("eclipse", "epl", [], [r"eclipse public licen[cs]e"], []),
    "edl": ("eclipse", "", [], [r"eclipse distribution licen[cs]e(?:" + V + " 1(?: 0)?)?"], [r"eclipse org org documents edl v10"]),
    "cddl": ("cddl", "cddl 1 [01]", [], ["development~common development and distribution licen[cs]e(?:" + V + " 1 [01])?", r"cddl(?: 1 [01])?"], [r"opensource org licenses? cddl1?"]),
    "cpl": ("common", "cpl 1 0", [], [r"common public licen[cs]e(?:" + V + " 1 0)?"], []),
    "cpal": ("common", "cpal 1 0", [], [r"common public attribution licen[cs]e(?:" + V + " 1 0)?"], []),
    "eupl": ("eupl", "eupl 1 [012]", [], ["european~european union public licen[cs]e(?:" + V + " 1 [012])?", r"eupl(?: v?1 [012])?"], [r"joinup ec europa eu .{0,60}?eupl"]),
    "artistic-1": ("artistic", "artistic 1 0(?: perl| cl8)?", [], [r"(?:the )?artistic licen[cs]e" + V + " 1(?: 0)?"], []),
    "artistic-2": ("artistic", "artistic 2 0", [], [r"(?:the )?artistic licen[cs]e" + V + " 2(?: 0)?"], [r"perlfoundation org artistic licen[cs]e 2 0"]),
    "artistic": ("artistic", "artistic", [r"under the same terms as perl itself .{0,60}?artistic"], [r"(?:the )?artistic licen[cs]e"], []),
    "zlib": ("zlib", "zlib", ["implied~this software is provided as is without any express or implied warranty in no event will the authors be held liable"], [r"(?:the )?zlib(?: libpng)? licen[cs]e"], [r"zlib net zlib license", r"opensource org licenses? zlib"]),
    "libpng": ("libpng", "libpng(?: 2 0)?", [], [r"(?:the )?libpng licen[cs]e"], []),
    "boost": ("boost", "bsl 1 0", [r"distributed under the boost software licen[cs]e"], [r"boost software licen[cs]e(?:" + V + " 1 0)?"], [r"boost org licen[cs]e 1 0(?: txt)?"]),
    "unlicense": ("unlicense", "unlicense", ["unencumbered~this is free and unencumbered software released into the public domain"], [r"(?:the )?unlicense"], [r"unlicense org"]),
    "wtfpl": ("wtfpl", "wtfpl", [], [r"wtfpl(?:" + V + " 2)?", "fuck~do what the fuck you want to public licen[cs]e"], [r"wtfpl net"]),
    "beerware": ("beer", "beerware", [r"buy me a beer in return"], [r"beer ?ware licen[cs]e"], []),
    "jsonlicense": ("evil", "json", [r"the software shall be used for good not evil"], [], []),
    "postgresql": ("postgresql", "postgresql", [], [r"(?:the )?postgresql licen[cs]e"], [r"opensource org licenses? postgresql"]),
    "python": ("python", "psf 2 0|python 2 0", [], [r"python software foundation licen[cs]e(?:" + V + " 2)?", r"python licen[cs]e(?: 2 0)?"], [r"docs python org (?:3 )?license"]),
    "php": ("php", "php 3 0[01]?", [], [r"(?:the )?php licen[cs]e(?:" + V + " 3 0[01]?)?"], [r"php net license(?: 3 0[01]?)?"]),
    "ruby": ("ruby", "ruby", [r"under the same terms as ruby(?: itself)?"], [r"(?:the )?ruby licen[cs]e"], [r"ruby lang org .{0,20}?license"]),
    "vim": ("vim", "vim", [], [r"(?:the )?vim licen[cs]e"], []),
    "openssl": ("openssl", "openssl", [r"this product includes software developed by the openssl project"], [r"(?:the )?openssl licen[cs]e"], []),
    "curl": ("curl", "curl", [], [r"(?:the )?curl licen[cs]e"], []),
    "ncsa": ("ncsa", "ncsa", [], [r"university of illinois ncsa open source licen[cs]e", r"ncsa licen[cs]e"], [r"opensource org licenses? ncsa"]),
    "upl": ("universal", "upl 1 0", [], [r"universal permissive licen[cs]e(?:" + V + " 1 0)?"], []),
    "ms-pl": ("microsoft", "ms pl", [], [r"microsoft public licen[cs]e"], [r"microsoft com .{0,30}?ms pl"]),
    "ms-rl": ("microsoft", "ms rl", [], [r"microsoft reciprocal licen[cs]e"], []),
    "apsl": ("apple", "apsl 2 0", [], [r"apple public source licen[cs]e(?:" + V + " [12](?: [012])?)?"], []),
    "ipl": ("ibm", "ipl 1 0", [], [r"ibm public licen[cs]e(?:" + V + " 1 0)?"], []),
    "osl-3": ("open", "osl 3 0", [], [r"open software licen[cs]e(?:" + V + " 3(?: 0)?)?"], []),
    "afl-3": ("academic", "afl 3 0", [], [r"academic free licen[cs]e(?:" + V + " 3(?: 0)?)?"], []),
    "ofl": ("font", "ofl 1 [01]", [], [r"(?:sil )?open font licen[cs]e(?:" + V + " 1 [01])?"], ["ofl~scripts sil org ofl"]),
    "lppl": ("latex", "lppl 1 [0123]c?", [r"under the conditions of the latex project public licen[cs]e"], [r"latex project public licen[cs]e(?:" + V + " 1 [0123]c?)?"], ["lppl~latex project org lppl"]),
    "bsl": ("business", "busl 1 1", [], [r"business source licen[cs]e(?:" + V + " 1 1)?"], ["bsl11~mariadb com bsl11"]),
    "sspl": ("sspl", "sspl 1 0", [], ["server~server side public licen[cs]e(?:" + V + " 1)?", r"sspl(?:v1)?"], [r"mongodb com .{0,40}?sspl"]),
    "elastic": ("elastic", "elastic 2 0", [], [r"elastic licen[cs]e(?:" + V + " 2(?: 0)?)?"], [r"elastic co licensing elastic license"]),
    "commons-clause": ("clause", "", [], [r"commons clause(?: licen[cs]e condition)?"], []),
    "cc0": ("cc0", "cc0 1 0", ["dedicated~dedicated (?:his|her|their|the) work to the public domain by waiving all", r"(?:licensed|released|available) under (?:the )?(?:creative commons )?cc0"], [r"cc0(?: 1 0)?(?: universal)?"], ["publicdomain~creativecommons org publicdomain zero(?: 1 0)?"]),
    "cc-by-nc-nd": ("cc", "cc by nc nd [1234] [05]", [r"licensed under (?:a )?cc by nc nd(?: [1234] [05])?"], [r"cc by nc nd(?: [1234] [05])?", "commons~creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"], ["creativecommons~creativecommons org licenses? by nc nd(?: [1234] [05])?"]),
    "cc-by-nc-sa": ("cc", "cc by nc sa [1234] [05]", [r"licensed under (?:a )?cc by nc sa(?: [1234] [05])?"], [r"cc by nc sa(?: [1234] [05])?", "commons~creative commons attribution non ?commercial share ?alike"], ["creativecommons~creativecommons org licenses? by nc sa(?: [1234] [05])?"]),
    "cc-by-nc": ("cc", "cc by nc [1234] [05]", [r"licensed under (?:a )?cc by nc(?: [1234] [05])?"], [r"cc by nc(?: [1234] [05])?", "commons~creative commons attribution non ?commercial"], ["creativecommons~creativecommons org licenses? by nc(?: [1234] [05])?"]),
    "cc-by-nd": ("cc", "cc by nd [1234] [05]", [r"licensed under (?:a )?cc by nd(?: [1234] [05])?"], [r"cc by nd(?: [1234] [05])?", "commons~creative commons attribution no ?deriv(?:ative)?s?"], ["creativecommons~creativecommons org licenses? by nd(?: [1234] [05])?"]),
    "cc-by-sa": ("cc", "cc by sa [1234] [05]", [r"licensed under (?:a )?cc by sa(?: [1234] [05])?"], [r"cc by sa(?: [1234] [05])?", "commons~creative commons attribution share ?alike"], ["creativecommons~creativecommons org licenses? by sa(?: [1234] [05])?"]),
    "cc-by": ("cc", "cc by [1234] [05]", [r"licensed under (?:a )?cc by(?: [1234] [05])?"], [r"cc by(?: [1234] [05])?", "commons~creative commons attribution"], ["creativecommons~creativecommons org licenses? by(?: [1234] [05])?"]),
    "cc": ("creative", "", ["commons~licensed under (?:a )?creative commons(?: licen[cs]e)?"], ["commons~creative commons licen[cs]e"], ["creativecommons~creativecommons org licenses?"]),
    "odbl": ("database", "odbl 1 0", [], [r"open (?:data commons open )?database licen[cs]e", "odbl~odbl(?: 1 0)?"], ["opendatacommons~opendatacommons org licenses? odbl"]),
    "odc-by": ("commons", "odc by 1 0", [], [r"open data commons attribution licen[cs]e"], ["opendatacommons~opendatacommons org licenses? by"]),
    "pddl": ("pddl", "pddl 1 0", [], ["dedication~(?:open data commons )?public domain dedication and licen[cs]e", "pddl"], ["opendatacommons~opendatacommons org licenses? pddl"]),
    "cdla": ("cdla", "cdla (?:permissive|sharing) [12] 0", [], ["community~community data licen[cs]e agreement", r"cdla (?:permissive|sharing)(?: [12] 0)?"], [r"cdla (?:io|dev)"]),
    "ogl": ("government", "ogl uk [123] 0", [r"contains public sector information licensed under the open government licen[cs]e"], [r"open government licen[cs]e(?:" + V + " [123](?: 0)?)?"], [r"nationalarchives gov uk doc open government licence"]),
    "openrail": ("rail", "", [], [r"open ?rail(?: m)? licen[cs]e", r"responsible ai licen[cs]e .{0,30}?rail", r"bigscience rail"], []),
    "llama": ("llama", "", [r"is licensed under the llama [234](?: [0123])? community licen[cs]e"], [r"llama [234](?: [0123])? community licen[cs]e(?: agreement)?"], []),
    "public-domain": ("domain", "", [r"(?:placed|released|dedicated) (?:in|into|to) the public domain"], [r"public domain mark(?: 1 0)?"], [r"creativecommons org publicdomain mark .{0,8}?domain|publicdomain mark"]),
}
HINTS = {
    "all-rights-reserved": [("rights", r"all rights reserved"), ("vorbehalten", r"alle rechte vorbehalten"), ("réservés", r"tous droits réservés"), ("reservados", r"todos los derechos reservados")],
    "proprietary": [("proprietary", r"proprietary and confidential"), ("reproduction", r"(?:unauthori[sz]ed )?reproduction (?:or distribution )?(?:in whole or in part )?is (?:strictly )?prohibited")],
    "copyright": [("copyright", r"copyright(?: c)? (?:19|20)[0-9][0-9]")],
    "license": [("licen", r"(?:this|the) (?:work|document|file|software|program|project|dataset|content) is licen[cs]ed under"), ("licen", r"see (?:the )?licen[cs]e(?: file)? for (?:more )?(?:details|information)")],
}


@dataclass(frozen=True)
class Rule:
    """`kind` settles its priority; `keyword`, a part of a word, is in each of its matches."""

    label: str
    kind: str
    keyword: str
    pattern: str

    @property
    def priority(self) -> int:
        return list(KINDS).index(self.kind)


def _rules() -> tuple[Rule, ...]:
    """The base phrases, then a rule per regex in the table's order, and one per identifier for
    tags ("SPDX-License-Identifier: MIT"; "License: MIT" at the head of a manifest)."""
    out = [Rule(label, "base", keyword, phrase) for label, keyword, phrase in BASE]
    for label, (keyword, tag, *columns) in SIGNATURES.items():
        if tag:
            out.append(Rule(label, "tag", "spdx", rf"spdx licen[cs]e identifier (?:{tag})"))
        for kind, patterns in zip(("notice", "name", "address"), columns):
            for p in patterns:
                p = p.replace(f"{V} ", f"{V} v?")
                own, cut, rest = p.partition("~")
                out.append(Rule(label, kind, own if cut else keyword, rest if cut else p))
    out += [Rule(label, "hint", keyword, p) for label, rules in HINTS.items() for keyword, p in rules]
    return tuple(out)


RULES = _rules()
#: A word: a run of what is no ASCII character but letters and digits; capitals still as they are.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(WORD)

Detection = tuple[int, int, int]  # first word, end (exclusive), place of the rule


def may_match(rules: Iterable[Rule], text: Column) -> Column:
    """Whether some rule's keyword stands in the text: no rule matches without."""
    low = F.lower(text)
    found = F.lit(False)
    for keyword in sorted({r.keyword for r in rules}):
        found = found | F.contains(low, F.lit(keyword))
    return found


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.translate(_LOWER))


class Scanner:
    """The rules, compiled, by keyword."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.by_keyword: dict[str, list[tuple[int, re.Pattern]]] = {}
        for i, r in enumerate(rules):
            self.by_keyword.setdefault(r.keyword, []).append((i, re.compile(f"(?<= )(?:{r.pattern})(?= )")))

    def detections(self, words: list[str]) -> list[Detection]:
        """All matches of all rules, before suppression."""
        joined = f" {' '.join(words)} "
        hits = [(m.start(), m.end(), i) for k, own in self.by_keyword.items() if k in joined for i, p in own for m in p.finditer(joined)]
        if not hits:
            return []
        starts = np.fromiter(accumulate((len(w) + 1 for w in words), initial=1), np.int64, len(words) + 1)
        return [(int(np.searchsorted(starts, a)), int(np.searchsorted(starts, b)), i) for a, b, i in hits]

    def kept(self, found: list[Detection]) -> list[Detection]:
        """Detections by place, without those inside another that prevails. In order of their
        starts, the longest first, a detection lies within an earlier one if that ends no sooner; so
        the furthest end of each priority is all there is to remember."""
        order = sorted(found, key=lambda d: (d[0], -d[1], self.rules[d[2]].priority, d[2]))
        furthest = [-1] * len(KINDS)
        out = []
        for d in order:
            p = self.rules[d[2]].priority
            if p == 0 or max(furthest[: p + 1]) < d[1]:
                out.append(d)
            furthest[p] = max(furthest[p], d[1])
        return out


def scan_licenses(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, detections: array<struct<label, kind, first_word, end_word, score>>, what is left after
    suppression, by place; one row per row of docs.

    Null text counts as empty; texts without words or detections have an empty array. Equal rows
    and null ids each get a row. Texts are searched whole, whatever their length: a text goes to Python if and
    only if it holds a keyword. Ties between equal intervals of one kind go to the earlier rule. Empty table: empty
    result. Other columns are not read.
    """
    text = text_or_empty()
    rows = docs.select("doc_id", F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.when(may_match(rules, text), text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(rules)

        def found(t: str | None) -> list[tuple]:
            if t is None:
                return []
            return [(rules[i].label, rules[i].kind, a, b, KINDS[rules[i].kind]) for a, b, i in scanner.kept(scanner.detections(words_of(t)))]

        for b in batches:
            yield pd.DataFrame({"doc_id": b.doc_id, "n_words": b.n_words, "detections": [[dict(zip(("label", "kind", "first_word", "end_word", "score"), d)) for d in found(t)] for t in b.text]})

    return rows.mapInPandas(scanned, f"doc_id {kind}, n_words long, detections array<struct<label:string,kind:string,first_word:long,end_word:long,score:double>>")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("detections", lambda d: d["kind"] == "base")
    starts = F.transform(base, lambda d: d["first_word"])
    labels = lambda ds: F.array_join(F.array_sort(F.array_distinct(F.transform(ds, lambda d: d["label"]))), ",")
    score = F.coalesce(F.array_max(F.transform("detections", lambda d: d["score"])), F.lit(0.0))
    return found.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("detections")).alias("labels"), score.alias("score"), F.size("detections").cast("long").alias("n_detections"))
