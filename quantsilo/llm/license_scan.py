"""License scans by ordered signature rules.

Rules are regular expressions with a label, a priority and a confidence.  A keyword automaton
decides which rules a text can match at all; the others never run.  Detections are settled by
priority: one whose interval lies inside that of a detection of the same or higher priority goes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo.llm.common import byte_set, plain_text, small_batches, text_buffer, word_spans

#: Base phrases: words that must stand consecutively, and their labels.
BASE = ((("mit", "license"), "mit"), (("apache", "license"), "apache"),
        (("general", "public", "license"), "gpl"))


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str          # on the lower-cased text
    keyword: str          # a string without white space that every match contains
    priority: int         # higher settles first
    confidence: float


#: label, SPDX id as a pattern, names as patterns (a space stands for any white space), words
#: that every name contains, and the places of the text on the web (host and path as a pattern).
LICENSES = [
    ("mit", r"mit", r"mit(?:/x11| \(expat\))?|expat|x11", "", r"opensource\.org/licenses?/mit"),
    ("mit-0", r"mit-0", r"mit no attribution", "mit no attribution", r"opensource\.org/license/mit-0"),
    ("apache-1.0", r"apache-1\.0", r"apache(?: software)? licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1\.0", "apache", r"apache\.org/licenses/license-1\.0"),
    ("apache-1.1", r"apache-1\.1", r"apache(?: software)? licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1\.1", "apache", r"apache\.org/licenses/license-1\.1"),
    ("apache-2.0", r"apache-2\.0", r"apache(?: software)? licen[sc]e,? (?:v(?:ersion |\.? ?)?)?2(?:\.0)?", "apache", r"apache\.org/licenses/license-2\.0"),
    ("gpl-1.0", r"gpl-1\.0(?:-only|-or-later|\+)?", r"(?:gnu )?general public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1(?:\.0)?", "general public", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0"),
    ("gpl-2.0", r"gpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu )?general public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?2(?:\.0)?", "general public", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", r"gpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu )?general public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?3(?:\.0)?", "general public", r"gnu\.org/licenses/gpl-3\.0"),
    ("lgpl-2.0", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"(?:gnu )?library general public licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?2(?:\.0)?)?", "library general public", r"gnu\.org/licenses/old-licenses/lgpl-2\.0"),
    ("lgpl-2.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"(?:gnu )?lesser general public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?2\.1", "lesser general public", r"gnu\.org/licenses/old-licenses/lgpl-2\.1"),
    ("lgpl-3.0", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu )?lesser general public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?3(?:\.0)?", "lesser general public", r"gnu\.org/licenses/lgpl-3\.0"),
    ("agpl-3.0", r"agpl-3\.0(?:-only|-or-later|\+)?", r"(?:gnu )?affero general public licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?3(?:\.0)?)?", "affero", r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl-1.3", r"gfdl-1\.3(?:-only|-or-later)?", r"(?:gnu )?free documentation licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?1\.3)?", "free documentation", r"gnu\.org/licenses/fdl-1\.3"),
    ("bsd-2-clause", r"bsd-2-clause", r"(?:simplified bsd|bsd 2-clause|2-clause bsd|freebsd)", "bsd", r"opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", r"bsd-3-clause", r"(?:new bsd|modified bsd|revised bsd|bsd 3-clause|3-clause bsd)", "bsd", r"opensource\.org/licenses?/bsd-3-clause"),
    ("bsd-4-clause", r"bsd-4-clause", r"(?:original bsd|bsd 4-clause|4-clause bsd)", "bsd", r"spdx\.org/licenses/bsd-4-clause"),
    ("0bsd", r"0bsd", r"(?:zero-clause bsd|bsd zero clause|0-clause bsd)", "bsd", r"opensource\.org/licenses?/0bsd"),
    ("isc", r"isc", r"isc|internet systems consortium", "", r"opensource\.org/licenses?/isc"),
    ("mpl-1.1", r"mpl-1\.1", r"mozilla public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1\.1", "mozilla", r"mozilla\.org/(?:en-us/)?mpl/1\.1"),
    ("mpl-2.0", r"mpl-2\.0", r"mozilla public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?2(?:\.0)?", "mozilla", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("epl-1.0", r"epl-1\.0", r"eclipse public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1(?:\.0)?", "eclipse", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", r"epl-2\.0", r"eclipse public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?2(?:\.0)?", "eclipse", r"eclipse\.org/legal/epl-(?:2\.0|v20)"),
    ("edl-1.0", r"edl-1\.0", r"eclipse distribution licen[sc]e", "eclipse distribution", r"eclipse\.org/org/documents/edl-v10"),
    ("cddl-1.0", r"cddl-1\.0", r"common development and distribution licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1\.0", "common development and distribution", r"opensource\.org/licenses?/cddl-1\.0"),
    ("cddl-1.1", r"cddl-1\.1", r"common development and distribution licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1\.1", "common development and distribution", r"spdx\.org/licenses/cddl-1\.1"),
    ("cpl-1.0", r"cpl-1\.0", r"common public licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?1\.0)?", "common public", r"opensource\.org/licenses?/cpl-?1\.0"),
    ("eupl-1.1", r"eupl-1\.1", r"european union public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1\.1", "european union public", r"joinup\.ec\.europa\.eu/\S*eupl-?v?1\.1"),
    ("eupl-1.2", r"eupl-1\.2", r"european union public licen[sc]e,? (?:v(?:ersion |\.? ?)?)?1\.2", "european union public", r"joinup\.ec\.europa\.eu/\S*eupl-?v?1\.2"),
    ("artistic-1.0", r"artistic-1\.0(?:-perl)?", r"artistic licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?1\.0)?", "artistic", r"opensource\.org/licenses?/artistic-?1\.0"),
    ("artistic-2.0", r"artistic-2\.0", r"artistic licen[sc]e,? (?:v(?:ersion |\.? ?)?)?2\.0", "artistic", r"opensource\.org/licenses?/artistic-?2\.0"),
    ("bsl-1.0", r"bsl-1\.0", r"boost software licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?1\.0)?", "boost software", r"boost\.org/license_1_0"),
    ("busl-1.1", r"busl-1\.1", r"business source licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?1\.1)?", "business source", r"mariadb\.com/bsl11"),
    ("zlib", r"zlib", r"zlib(?:/libpng)?", "zlib", r"opensource\.org/licenses?/zlib"),
    ("libpng", r"libpng(?:-2\.0)?", r"libpng", "libpng", r"libpng\.org/pub/png/src/libpng-license"),
    ("unlicense", r"unlicense", r"(?:the )?unlicense", "unlicense", r"unlicense\.org"),
    ("wtfpl", r"wtfpl", r"do what the fuck you want to public licen[sc]e", "do what the", r"wtfpl\.net"),
    ("postgresql", r"postgresql", r"postgresql", "postgresql", r"opensource\.org/licenses?/postgresql"),
    ("python-2.0", r"(?:python|psf)-2\.0", r"(?:python software foundation|psf)", "", r"docs\.python\.org/\d/license"),
    ("php-3.01", r"php-3\.01", r"php licen[sc]e,? (?:v(?:ersion |\.? ?)?)?3\.01", "php", r"php\.net/license/3_01"),
    ("ruby", r"ruby", r"ruby", "ruby", r"ruby-lang\.org/en/about/license"),
    ("ncsa", r"ncsa", r"university of illinois/ncsa(?: open source)?", "university of illinois", r"opensource\.org/licenses?/ncsa"),
    ("ms-pl", r"ms-pl", r"microsoft public licen[sc]e", "microsoft public", r"opensource\.org/licenses?/ms-pl"),
    ("ms-rl", r"ms-rl", r"microsoft reciprocal licen[sc]e", "microsoft reciprocal", r"opensource\.org/licenses?/ms-rl"),
    ("osl-3.0", r"osl-3\.0", r"open software licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?3\.0)?", "open software", r"opensource\.org/licenses?/osl-3\.0"),
    ("afl-3.0", r"afl-3\.0", r"academic free licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?3\.0)?", "academic free", r"opensource\.org/licenses?/afl-3\.0"),
    ("ecl-2.0", r"ecl-2\.0", r"educational community licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?2\.0)?", "educational community", r"opensource\.org/licenses?/ecl-2\.0"),
    ("upl-1.0", r"upl-1\.0", r"universal permissive licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?1\.0)?", "universal permissive", r"oss\.oracle\.com/licenses/upl"),
    ("ofl-1.1", r"ofl-1\.1", r"(?:sil )?open font licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?1\.1)?", "open font", r"scripts\.sil\.org/ofl"),
    ("blueoak-1.0.0", r"blueoak-1\.0\.0", r"blue oak model licen[sc]e(?: 1\.0\.0)?", "blue oak", r"blueoakcouncil\.org/license/1\.0\.0"),
    ("mulanpsl-2.0", r"mulanpsl-2\.0", r"mulan (?:psl|permissive software licen[sc]e)(?:,? (?:v(?:ersion |\.? ?)?)?2)?", "mulan", r"license\.coscl\.org\.cn/mulanpsl2"),
    ("sspl-1.0", r"sspl-1\.0", r"server side public licen[sc]e(?:,? (?:v(?:ersion |\.? ?)?)?1)?", "server side public", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic-2.0", r"elastic-2\.0", r"elastic licen[sc]e(?: 2\.0)?", "elastic", r"elastic\.co/licensing/elastic-license"),
    ("polyform-nc-1.0.0", r"polyform-noncommercial-1\.0\.0", r"polyform noncommercial licen[sc]e", "polyform noncommercial", r"polyformproject\.org/licenses/noncommercial"),
    ("cc0-1.0", r"cc0-1\.0", r"(?:creative commons )?(?:cc0(?: 1\.0)?|public domain dedication)", "", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by-3.0", r"cc-by-3\.0", r"cc[ -]by[ -]3\.0", "cc", r"creativecommons\.org/licenses/by/3\.0"),
    ("cc-by-4.0", r"cc-by-4\.0", r"cc[ -]by[ -]4\.0", "cc", r"creativecommons\.org/licenses/by/4\.0"),
    ("cc-by-sa-3.0", r"cc-by-sa-3\.0", r"cc[ -]by-sa[ -]3\.0", "by-sa", r"creativecommons\.org/licenses/by-sa/3\.0"),
    ("cc-by-sa-4.0", r"cc-by-sa-4\.0", r"cc[ -]by-sa[ -]4\.0", "by-sa", r"creativecommons\.org/licenses/by-sa/4\.0"),
    ("cc-by-nc-3.0", r"cc-by-nc-3\.0", r"cc[ -]by-nc[ -]3\.0", "by-nc", r"creativecommons\.org/licenses/by-nc/3\.0"),
    ("cc-by-nc-4.0", r"cc-by-nc-4\.0", r"cc[ -]by-nc[ -]4\.0", "by-nc", r"creativecommons\.org/licenses/by-nc/4\.0"),
    ("cc-by-nd-4.0", r"cc-by-nd-4\.0", r"cc[ -]by-nd[ -]4\.0", "by-nd", r"creativecommons\.org/licenses/by-nd/4\.0"),
    ("cc-by-nc-sa-4.0", r"cc-by-nc-sa-4\.0", r"cc[ -]by-nc-sa[ -]4\.0", "by-nc-sa", r"creativecommons\.org/licenses/by-nc-sa/4\.0"),
    ("cc-by-nc-nd-4.0", r"cc-by-nc-nd-4\.0", r"cc[ -]by-nc-nd[ -]4\.0", "by-nc-nd", r"creativecommons\.org/licenses/by-nc-nd/4\.0"),
    ("odbl-1.0", r"odbl-1\.0", r"open (?:data commons open )?database licen[sc]e", "database", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", r"odc-by-1\.0", r"open data commons attribution licen[sc]e", "open data commons attribution", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", r"pddl-1\.0", r"open data commons public domain dedication", "open data commons public", r"opendatacommons\.org/licenses/pddl"),
    ("openrail", r"openrail(?:\+\+)?(?:-m)?", r"(?:creativeml )?open ?rail(?:\+\+)?(?:-m)?", "rail", r"huggingface\.co/spaces/bigscience/license"),
    ("vim", r"vim", r"vim", "vim", r"vimhelp\.org/uganda"),
    ("openssl", r"openssl", r"openssl", "openssl", r"openssl\.org/source/license"),
    ("curl", r"curl", r"curl", "curl", r"curl\.se/docs/copyright"),
]

#: Notices and clauses that name no version: label, pattern, keyword, priority, confidence.
PHRASES = [
    ("apache", r"apache(?: software)? licen[sc]e", "apache", 1, 0.7),
    ("gpl", r"(?:gnu )?general public licen[sc]e", "general public", 1, 0.7),
    ("gpl", r"gnu gpl(?: ?v?\d(?:\.\d)?)?", "gnu gpl", 1, 0.7),
    ("gpl", r"gplv[23]\+?", "gplv", 1, 0.7),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", "general public", 2, 0.7),
    ("mpl", r"mozilla public licen[sc]e", "mozilla public", 1, 0.7),
    ("epl", r"eclipse public licen[sc]e", "eclipse public", 1, 0.7),
    ("bsd", r"bsd(?:-style)? licen[sc]e", "bsd", 1, 0.6),
    ("mit", r"mit(?:-style)? licen[sc]e", "mit", 1, 0.7),
    ("cc", r"creative commons(?: [a-z-]+){0,4} licen[sc]e", "creative commons", 1, 0.6),
    ("cc-by", r"creative commons attribution(?: \d\.\d)?(?: international| unported| generic)?", "creative commons attribution", 2, 0.7),
    ("cc-by-sa", r"creative commons attribution[ -]share ?alike(?: \d\.\d)?", "creative commons attribution", 3, 0.8),
    ("cc-by-nc", r"creative commons attribution[ -]non-?commercial(?: \d\.\d)?", "creative commons attribution", 3, 0.8),
    ("cc-by-nd", r"creative commons attribution[ -]no-?derivatives?(?: \d\.\d)?", "creative commons attribution", 3, 0.8),
    ("public-domain", r"(?:(?:released|placed|dedicated) )?(?:in|into|to) the public domain", "public domain", 1, 0.6),
    ("proprietary", r"all rights reserved", "all rights reserved", 0, 0.3),
    ("proprietary", r"proprietary and confidential", "proprietary and confidential", 2, 0.8),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|distribution)", "unauthori", 1, 0.6),
    ("copyright", r"copyright (?:(?:\(c\)|©) ?)?(?:19|20)\d\d", "copyright", 0, 0.3),
    ("copyright", r"© ?(?:19|20)\d\d", "©", 0, 0.3),
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy", "permission is hereby granted", 4, 1.0),
    ("isc", r"permission to use, copy, modify, and/or distribute this software for any purpose", "permission to use", 4, 1.0),
    ("bsd", r"redistribution and use in source and binary forms, with or without modification", "redistribution and use", 4, 1.0),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[sc]e", "in compliance with the", 4, 1.0),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public", "this source code form", 4, 1.0),
    ("gpl", r"this program is free software[:;,] you can redistribute it", "this program is free software", 4, 1.0),
    ("lgpl", r"this library is free software[:;,] you can redistribute it", "this library is free software", 4, 1.0),
    ("zlib", r"this software is provided 'as-is', without any express or implied warranty", "provided 'as-is'", 4, 1.0),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "free and unencumbered", 4, 1.0),
    ("bsl-1.0", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy", "permission is hereby granted", 5, 1.0),
    ("cc0-1.0", r"to the extent possible under law, .{1,80} waived all copyright", "to the extent possible under law", 4, 1.0),
]

_SPDX = "spdx-license-identifier"


_SPDX = "spdx-license-identifier"


def _flex(pattern: str) -> str:
    """A space stands for any white space, an optional one also for none, one beside a hyphen in brackets for one."""
    return re.sub(r"\[ -\]| \?| ", lambda m: {"[ -]": r"[\s-]", " ?": r"\s*"}.get(m[0], r"\s+"), pattern)


def _longest(words: str) -> str:
    return max(words.split(), key=len, default="")


def build_rules() -> list[Rule]:
    """Every license in four hand-written forms (tag, name, "licensed under", link), and PHRASES.

    A rule's keyword is the longest word of those that stand in each of its matches.
    """
    rules = []
    for label, spdx, names, key, link in LICENSES:
        named, key = r"(?:%s)" % _flex(names), _longest(key)
        rules.append(Rule(label, rf"{_SPDX}\s*:\s*(?:{spdx})(?![\w.+-])", _SPDX, 6, 1.0))
        if "licen[sc]e" in names:
            rules.append(Rule(label, rf"(?<!\w){named}(?!\w|\.\d)", key, 3, 0.9))
        else:
            rules.append(Rule(label, rf"(?<!\w){named}\s+(?:open\s+source\s+)?licen[sc]e(?!\w)", "licen", 3, 0.9))
        rules.append(Rule(label, rf"(?:licensed|released|distributed|available|published)\s+under\s+(?:the\s+)?"
                                 rf"(?:terms\s+of\s+(?:the\s+)?)?{named}(?!\w|\.\d)", key or "under", 4, 0.95))
        host = re.match(r"[\w-]+", link)[0]
        rules.append(Rule(label, rf"(?:https?://)?(?:www\.)?{link}", host, 5, 0.95))
    for label, pattern, key, priority, confidence in PHRASES:
        rules.append(Rule(label, rf"(?<!\w){_flex(pattern)}(?!\w)", _longest(key), priority, confidence))
    return rules


RULES = build_rules()


class Scanner:
    """Compiled rules behind their keywords; it pickles as the rules."""

    def __init__(self, rules: list[Rule] = RULES):
        self.rules, self._made = list(rules), None

    def __getstate__(self):
        return {"rules": self.rules, "_made": None}

    def _setup(self):
        by_key: dict[str, list[int]] = {}
        for i, r in enumerate(self.rules):
            by_key.setdefault(r.keyword, []).append(i)
        gate = ahocorasick.Automaton()
        for key, which in by_key.items():
            gate.add_word(key, which)
        gate.make_automaton()
        self._made = gate, [re.compile(r.pattern) for r in self.rules]
        return self._made

    def candidates(self, text: str) -> set[int]:
        """Rules whose keyword stands in the (lower-cased) text."""
        gate, _ = self._made or self._setup()
        found: set[int] = set()
        for _, which in gate.iter(text):
            found.update(which)
        return found

    def detect(self, text: str) -> list[tuple[int, int, Rule]]:
        """(start, end, rule) of the detections that remain, by start; the text is lower-cased."""
        rules = sorted(self.candidates(text))
        if not rules:
            return []
        _, compiled = self._made
        found = [(*m.span(), i) for i in rules for m in compiled[i].finditer(text) if m.end() > m.start()]
        return [(a, b, self.rules[i]) for a, b, i in self.settle(found)]

    def settle(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Drop every interval inside one of the same or a higher priority; equal ones: the first rule stays.

        In order of start and falling end every container stands before what it contains, so the
        furthest end so far at each priority level answers it in one pass.
        """
        level = lambda i: self.rules[i].priority
        reach: dict[int, int] = {}
        kept = []
        for a, b, i in sorted(found, key=lambda x: (x[0], -x[1], -level(x[2]), x[2])):
            if any(end >= b for p, end in reach.items() if p >= level(i)):
                continue
            kept.append((a, b, i))
            reach[level(i)] = max(reach.get(level(i), 0), b)
        return kept


_WORD = byte_set(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_IN, _OUT = rb"[0-9A-Za-z\x80-\xff]", rb"[^0-9A-Za-z\x80-\xff]"
_BASE = [(re.compile(rb"(?<!" + _IN + rb")" + (_OUT + rb"+").join(w.encode() for w in words) + rb"(?!" + _IN + rb")",
                     re.IGNORECASE), label) for words, label in BASE]


def base_places(raw: bytes, word_starts: np.ndarray) -> tuple[list[int], list[str]]:
    """Word indexes where a base phrase starts, and the labels found; bytes case-fold A-Z only."""
    at, labels = [], []
    for pattern, label in _BASE:
        got = [m.start() for m in pattern.finditer(raw)]
        if got:
            at += np.searchsorted(word_starts, got).tolist()
            labels.append(label)
    return at, labels


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """Licenses of every whole text, one row for each input row.

    Returns ``id_col``, n_words, n_base, first_word, last_word, base_labels, labels, score and
    detections (array of start, end, label, confidence; code points of the text lower-cased by
    Unicode's rules, which keeps its length but for a few letters such as the dotted capital I).
    Null counts as empty: no words, null places, empty labels, score 0.  Each text is on its own,
    so ties and repeated rows need no rule; other columns are ignored.
    One narrow pass; texts without any keyword run no expression.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    scanner = Scanner(rules)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()),
                                ("confidence", pa.float64())]))

    def run(batches):
        for b in batches:
            data, off = text_buffer(b.column(1))
            starts, _, words = word_spans(data, off, _WORD)
            out = {k: [] for k in ("n_base", "first", "last", "base", "labels", "score", "spans")}
            for k, text in enumerate(b.column(1).to_pylist()):
                low = text.lower()
                found = scanner.detect(low)
                places, base = [], []
                if "license" in low:
                    places, base = base_places(data[off[k]:off[k + 1]].tobytes(),
                                               starts[words[k]:words[k + 1]] - off[k])
                out["n_base"].append(len(places))
                out["first"].append(min(places, default=None))
                out["last"].append(max(places, default=None))
                out["base"].append(",".join(sorted(base)))
                out["labels"].append(",".join(sorted({*base, *(r.label for *_, r in found)})))
                out["score"].append(max([0.8] * bool(base) + [r.confidence for *_, r in found], default=0.0))
                out["spans"].append([{"start": a, "end": z, "label": r.label, "confidence": r.confidence}
                                     for a, z, r in found])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), spans)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(words).astype(np.int64))]
                + [pa.array(v, t) for v, t in zip(out.values(), kinds)],
                ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])

    return (docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, n_words long, n_base long, first_word long, last_word long, "
                             "base_labels string, labels string, score double, "
                             "detections array<struct<start int, end int, label string, confidence double>>")
            .withColumnRenamed("id", id_col))
