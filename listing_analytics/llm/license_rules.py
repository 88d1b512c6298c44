"""License scans: ordered signature rules behind a keyword prefilter.

First come rules for what stands in license texts and notices, and for addresses of licenses. The others are the product
of a table of licenses (a pattern for the name, one for the identifier, keywords) and a list of contexts in which a
license is named, from a tag that leaves no doubt to a bare identifier. Their order is their priority. One automaton over all keywords reads each text once; only rules of licenses whose keyword occurs run their
pattern. A detection inside the interval of one with a higher priority is suppressed, so "gnu lesser general public
license" does not also count as the plain one.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from listing_analytics.llm.common import as_bytes, prepare, table, texts
from listing_analytics.llm.registry import query

# Phrases whose words are counted wherever they stand in a row, and their labels.
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]

# Label, confidence, pattern, keywords. Sentences of license texts and notices, then addresses.
BODIES = [
    ("boost-1.0", 0.95, r"permission is hereby granted, free of charge, to any person or organi[sz]ation obtaining a copy", "free of charge, to any person or"),
    ("mit", 0.95, r"permission is hereby granted, free of charge, to any person obtaining a copy", "free of charge, to any person obtaining"),
    ("isc", 0.95, r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee", "with or without fee"),
    ("bsd-4-clause", 0.95, r"all advertising materials mentioning features or use of this software must display", "advertising materials"),
    ("bsd-3-clause", 0.9, r"neither the names? of (?:[a-z0-9,&<>]+ ){1,20}may be used to endorse or promote products", "endorse or promote products"),
    ("bsd", 0.9, r"redistribution and use in source and binary forms", "source and binary forms"),
    ("agpl-3.0", 0.95, r"gnu affero general public license as published by the free software foundation[,;] either version 3", "affero general public license as published"),
    ("lgpl-3.0", 0.95, r"gnu lesser general public license as published by the free software foundation[,;] either version 3", "lesser general public license as published"),
    ("lgpl-2.1", 0.95, r"gnu lesser general public license as published by the free software foundation[,;] either version 2\.1", "lesser general public license as published"),
    ("lgpl-2.0", 0.95, r"gnu library general public license as published by the free software foundation[,;] either version 2", "library general public license as published"),
    ("gpl-3.0", 0.95, r"gnu general public license as published by the free software foundation[,;] either version 3", "general public license as published"),
    ("gpl-2.0", 0.95, r"gnu general public license as published by the free software foundation[,;] either version 2", "general public license as published"),
    ("gpl", 0.9, r"this program is free software[:;,] you can redistribute it and/or modify", "program is free software"),
    ("lgpl-2.1", 0.8, r"this library is free software[:;,] you can redistribute it and/or modify", "library is free software"),
    ("gpl", 0.9, r"copy and distribute verbatim copies of this license document, but changing it is not allowed", "verbatim copies"),
    ("wtfpl", 0.95, r"copy and distribute verbatim or modified copies of this license document, and changing it is allowed", "verbatim or modified copies"),
    ("gfdl", 0.95, r"copy, distribute and/or modify this document under the terms of the gnu free documentation license", "gnu free documentation"),
    ("apache-2.0", 0.95, r"licensed under the apache license, version 2\.0 \(the \"license\"\)", "apache license, version"),
    ("apache-2.0", 0.9, r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed", "required by applicable law"),
    ("mpl-2.0", 0.95, r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0", "source code form"),
    ("mpl-1.1", 0.95, r"the contents of this file are subject to the mozilla public license version 1\.1", "contents of this file"),
    ("epl-2.0", 0.95, r"the accompanying materials are made available under the terms of the eclipse public license(?: v(?:ersion)? ?2(?:\.0)?| 2\.0)", "accompanying materials"),
    ("epl-1.0", 0.95, r"the accompanying materials are made available under the terms of the eclipse public license v(?:ersion)? ?1(?:\.0)?", "accompanying materials"),
    ("cddl", 0.95, r"subject to the terms of the common development and distribution license", "development and distribution"),
    ("zlib", 0.9, r"this software is provided 'as-is', without any express or implied warranty", "'as-is'"),
    ("unlicense", 0.95, r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("cc0-1.0", 0.95, r"waived all copyright and related (?:or|and) neighbou?ring rights", "waived all copyright"),
    ("public-domain", 0.9, r"this (?:work|file|software|document) is in the public domain", "the public domain"),
    ("ofl-1.1", 0.95, r"this font software is licensed under the sil open font license", "font software"),
    ("artistic-2.0", 0.9, r"the artistic license 2\.0 copyright \(c\) 2000-2006, the perl foundation", "perl foundation"),
    ("psf", 0.9, r"psf is making python available to licensee on an \"as is\" basis", "psf is making"),
    ("all-rights-reserved", 0.7, r"no part of this (?:publication|book|work|document|website) may be (?:copied|reproduced)", "no part of this"),
    ("no-warranty", 0.4, r"(?:is|are) provided (?:\"as is\"|'as is'|as is|“as is”)", "as is"),
    ("cc-by-nc-nd", 0.95, r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.[05]", "creativecommons.org/licenses/by-nc-nd"),
    ("cc-by-nc-sa", 0.95, r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.[05]", "creativecommons.org/licenses/by-nc-sa"),
    ("cc-by-nc", 0.95, r"creativecommons\.org/licenses/by-nc/[1-4]\.[05]", "creativecommons.org/licenses/by-nc/"),
    ("cc-by-nd", 0.95, r"creativecommons\.org/licenses/by-nd/[1-4]\.[05]", "creativecommons.org/licenses/by-nd"),
    ("cc-by-sa", 0.95, r"creativecommons\.org/licenses/by-sa/[1-4]\.[05]", "creativecommons.org/licenses/by-sa"),
    ("cc-by", 0.95, r"creativecommons\.org/licenses/by/[1-4]\.[05]", "creativecommons.org/licenses/by/"),
    ("cc0-1.0", 0.95, r"creativecommons\.org/publicdomain/zero/1\.0", "creativecommons.org/publicdomain/zero"),
    ("public-domain", 0.9, r"creativecommons\.org/publicdomain/mark/1\.0", "creativecommons.org/publicdomain/mark"),
    ("apache-2.0", 0.95, r"apache\.org/licenses/license-2\.0", "apache.org/licenses"),
    ("mit", 0.95, r"opensource\.org/licenses?/mit(?:-license)?", "opensource.org/license"),
    ("bsd-3-clause", 0.95, r"opensource\.org/licenses?/bsd-3-clause", "opensource.org/license"),
    ("bsd-2-clause", 0.95, r"opensource\.org/licenses?/bsd-2-clause", "opensource.org/license"),
    ("isc", 0.95, r"opensource\.org/licenses?/isc", "opensource.org/license"),
    ("gpl-3.0", 0.95, r"gnu\.org/licenses/(?:old-licenses/)?gpl-3\.0", "gnu.org/licenses"),
    ("gpl-2.0", 0.95, r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0", "gnu.org/licenses"),
    ("lgpl-3.0", 0.95, r"gnu\.org/licenses/lgpl-3\.0", "gnu.org/licenses"),
    ("lgpl-2.1", 0.95, r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", "gnu.org/licenses"),
    ("agpl-3.0", 0.95, r"gnu\.org/licenses/agpl-3\.0", "gnu.org/licenses"),
    ("gfdl", 0.95, r"gnu\.org/(?:licenses|copyleft)/fdl(?:-1\.[1-3])?", "gnu.org/licenses|gnu.org/copyleft"),
    ("gpl", 0.8, r"gnu\.org/(?:licenses|copyleft)(?:/gpl)?", "gnu.org/licenses|gnu.org/copyleft"),
    ("mpl-2.0", 0.95, r"mozilla\.org/(?:en-us/)?mpl/2\.0", "mozilla.org"),
    ("mpl-1.1", 0.95, r"mozilla\.org/mpl/(?:mpl-)?1\.1", "mozilla.org"),
    ("epl-2.0", 0.95, r"eclipse\.org/legal/epl-(?:2\.0|v20)", "eclipse.org/legal"),
    ("epl-1.0", 0.95, r"eclipse\.org/legal/epl-(?:1\.0|v10)", "eclipse.org/legal"),
    ("boost-1.0", 0.95, r"boost\.org/license_1_0", "boost.org/license"),
    ("unlicense", 0.95, r"unlicense\.org", "unlicense.org"),
    ("ofl-1.1", 0.95, r"scripts\.sil\.org/ofl", "scripts.sil.org"),
    ("wtfpl", 0.95, r"wtfpl\.net", "wtfpl.net"),
    ("odbl", 0.95, r"opendatacommons\.org/licenses/odbl", "opendatacommons.org"),
]

# label, pattern of the name, pattern of the identifier, keywords (every match of either pattern in a text in which white
# space is single blanks contains one of them). Special licenses stand before general ones.
_V = r",?\s+(?:version\s+|v\.?\s*)?"
_CC = r"(?:creative\s+commons|cc)[\s-]+"
LICENSES = [
    ("agpl-3.0", rf"(?:gnu\s+)?affero\s+general\s+public\s+license(?:{_V}3(?:\.0)?)?", r"agpl(?:[\s-]*v?3(?:\.0)?)?(?:-only|-or-later)?", "affero|agpl"),
    ("lgpl-3.0", rf"(?:gnu\s+)?lesser\s+general\s+public\s+license{_V}3(?:\.0)?", r"lgpl[\s-]*v?3(?:\.0)?(?:-only|-or-later)?", "lesser general|lgpl"),
    ("lgpl-2.1", rf"(?:gnu\s+)?lesser\s+general\s+public\s+license(?:{_V}2\.1)?", r"lgpl(?:[\s-]*v?2(?:\.[01])?)?(?:-only|-or-later)?", "lesser general|lgpl"),
    ("lgpl-2.0", rf"(?:gnu\s+)?library\s+general\s+public\s+license(?:{_V}2(?:\.0)?)?", r"lgpl-2\.0(?:-only|-or-later)?", "library general|lgpl"),
    ("gfdl", rf"(?:gnu\s+)?free\s+documentation\s+license(?:{_V}1\.[1-3])?", r"gfdl(?:-1\.[1-3])?", "documentation license|gfdl"),
    ("gpl-3.0", rf"(?:gnu\s+)?general\s+public\s+license{_V}3(?:\.0)?", r"(?:gnu\s+)?gpl[\s-]*v?3(?:\.0)?(?:-only|-or-later|\+)?", "general public|gpl"),
    ("gpl-2.0", rf"(?:gnu\s+)?general\s+public\s+license{_V}2(?:\.0)?", r"(?:gnu\s+)?gpl[\s-]*v?2(?:\.0)?(?:-only|-or-later|\+)?", "general public|gpl"),
    ("gpl", r"(?:gnu\s+)?general\s+public\s+license", r"(?:gnu\s+)?gpl", "general public|gpl"),
    ("apache-2.0", rf"apache\s+(?:software\s+)?license(?:{_V}2(?:\.0)?)", r"apache[\s-]*v?2(?:\.0)?", "apache"),
    ("apache-1.1", rf"apache\s+(?:software\s+)?license(?:{_V}1\.[01])", r"apache-1\.[01]", "apache"),
    ("apache", r"apache\s+(?:software\s+|public\s+)?license", r"apache-licensed", "apache"),
    ("mit-0", r"mit\s+no\s+attribution(?:\s+license)?", r"mit-0", "mit no|mit-0"),
    ("mit", r"(?:mit|expat|x11)\s+license", r"(?:mit-licensed|(?<=identifier: )mit|(?<=license: )mit|(?<=under )mit|(?<=under the )mit)",
     "mit license|mit-licensed|identifier: mit|license: mit|under mit|under the mit|expat|x11"),
    ("bsd-4-clause", r"(?:original|4[\s-]clause|four[\s-]clause)\s+bsd(?:\s+license)?", r"bsd[\s-]4(?:[\s-]clause)?", "bsd"),
    ("bsd-3-clause", r"(?:new|modified|revised|3[\s-]clause|three[\s-]clause)\s+bsd(?:\s+license)?", r"bsd[\s-]3(?:[\s-]clause)?", "bsd"),
    ("bsd-2-clause", r"(?:simplified|freebsd|2[\s-]clause|two[\s-]clause)\s+bsd(?:\s+license)?", r"bsd[\s-]2(?:[\s-]clause)?", "bsd"),
    ("0bsd", r"(?:zero[\s-]clause|free\s+public)\s+bsd(?:\s+license)?", r"0bsd", "bsd"),
    ("bsd", r"bsd(?:[\s-]style)?\s+license", r"bsd-licensed", "bsd"),
    ("mpl-2.0", rf"mozilla\s+public\s+license(?:{_V}2(?:\.0)?)?", r"mpl[\s-]*v?2(?:\.0)?", "mozilla public|mpl-|mpl |mplv|mpl1|mpl2"),
    ("mpl-1.1", rf"mozilla\s+public\s+license{_V}1\.[01]", r"mpl[\s-]*v?1\.[01]", "mozilla public|mpl-|mpl |mplv|mpl1|mpl2"),
    ("epl-2.0", rf"eclipse\s+public\s+license(?:{_V}2(?:\.0)?)?", r"epl[\s-]*v?2(?:\.0)?", "eclipse public|epl-|epl |eplv|epl1|epl2"),
    ("epl-1.0", rf"eclipse\s+public\s+license{_V}1(?:\.0)?", r"epl[\s-]*v?1(?:\.0)?", "eclipse public|epl-|epl |eplv|epl1|epl2"),
    ("cddl", rf"common\s+development\s+and\s+distribution\s+license(?:{_V}1\.[01])?", r"cddl(?:-1\.[01])?", "development and distribution|cddl"),
    ("cpl-1.0", r"common\s+public\s+license(?:,?\s+version\s+1\.0)?", r"cpl-1\.0", "common public|cpl-"),
    ("eupl", rf"european\s+union\s+public\s+licen[cs]e(?:{_V}1\.[0-2])?", r"eupl(?:-1\.[0-2])?", "european|eupl"),
    ("isc", r"isc\s+license", r"isc-licensed", "isc licen|isc-licen"),
    ("zlib", r"zlib(?:/libpng)?\s+license", r"zlib-licensed", "zlib"),
    ("libpng", r"libpng\s+license", r"libpng-2\.0", "libpng"),
    ("boost-1.0", rf"boost\s+software\s+license(?:{_V}1\.0)?", r"bsl-1\.0", "boost software|bsl-"),
    ("unlicense", r"(?:the\s+)?unlicense(?:\s+license)?", r"unlicensed\s+to\s+the\s+public\s+domain", "unlicense"),
    ("wtfpl", r"do\s+what\s+the\s+\w+\s+you\s+want\s+to\s+public\s+license", r"wtfpl", "to public license|wtfpl"),
    ("artistic-2.0", rf"artistic\s+license{_V}2(?:\.0)?", r"artistic-2\.0", "artistic"),
    ("artistic", r"(?:clarified\s+)?artistic\s+license", r"artistic-1\.0", "artistic"),
    ("psf", r"(?:python\s+software\s+foundation|psf)\s+license", r"psf-2\.0", "python|psf"),
    ("ms-pl", r"microsoft\s+public\s+license", r"ms-pl", "microsoft|ms-pl"),
    ("ms-rl", r"microsoft\s+reciprocal\s+license", r"ms-rl", "microsoft|ms-rl"),
    ("ofl-1.1", rf"(?:sil\s+)?open\s+font\s+license(?:{_V}1\.[01])?", r"ofl(?:-1\.[01])", "font license|ofl-"),
    ("odbl", rf"open\s+(?:data\s+commons\s+open\s+)?database\s+license(?:{_V}1\.0)?", r"odbl(?:-1\.0)?", "database license|odbl"),
    ("cc0-1.0", rf"{_CC}(?:zero|0)(?:\s+1\.0)?(?:\s+universal)?", r"cc0(?:-1\.0)?", "creative|cc0|cc |cc-"),
    ("cc-by-nc-nd", rf"{_CC}attribution[\s-]+non-?commercial[\s-]+no-?deriv(?:ative)?s?", r"cc[\s-]by[\s-]nc[\s-]nd(?:[\s-][1-4]\.[05])?", "creative|cc |cc-"),
    ("cc-by-nc-sa", rf"{_CC}attribution[\s-]+non-?commercial[\s-]+share-?alike", r"cc[\s-]by[\s-]nc[\s-]sa(?:[\s-][1-4]\.[05])?", "creative|cc |cc-"),
    ("cc-by-nc", rf"{_CC}attribution[\s-]+non-?commercial", r"cc[\s-]by[\s-]nc(?:[\s-][1-4]\.[05])?", "creative|cc |cc-"),
    ("cc-by-nd", rf"{_CC}attribution[\s-]+no-?deriv(?:ative)?s?", r"cc[\s-]by[\s-]nd(?:[\s-][1-4]\.[05])?", "creative|cc |cc-"),
    ("cc-by-sa", rf"{_CC}attribution[\s-]+share-?alike", r"cc[\s-]by[\s-]sa(?:[\s-][1-4]\.[05])?", "creative|cc |cc-"),
    ("cc-by", rf"{_CC}attribution(?:\s+license)?", r"cc[\s-]by(?:[\s-][1-4]\.[05])?", "creative|cc |cc-"),
    ("public-domain", r"(?:dedicated\s+to|released\s+into|placed\s+in)\s+the\s+public\s+domain", r"public-domain", "public domain|public-domain"),
    ("all-rights-reserved", r"all\s+rights\s+reserved", r"\(c\)\s+all\s+rights", "rights reserved|all rights"),
]

# How a license is named, surest first, with the confidence of such a detection. {n}: name, {i}: identifier.
CONTEXTS = [
    (r"spdx-license-identifier\s*:\s*(?:{i}|{n})", 0.99),
    (r"(?:sub)?licen[cs]ed\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+|an?\s+)?(?:{n}|{i})", 0.95),
    (r"(?:released|distributed|available|provided|published|redistributed)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+|an?\s+)?(?:{n}|{i})", 0.9),
    (r"licen[cs]e\s*[:=]\s*[\"']?(?:{n}|{i})", 0.8),
    (r"{n}", 0.7),
    (r"{i}", 0.5),
]
BASE_CONFIDENCE = 0.6


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    pattern: re.Pattern
    confidence: float


def _both(text: str, spelling: str) -> str:
    """Licence is spelt both ways."""
    return text.replace("license", spelling)


@lru_cache(maxsize=1)
def rules() -> tuple[list[Rule], ahocorasick.Automaton]:
    """All rules in order of priority, and the automaton from keyword to the rules that it opens."""
    written = [(label, confidence, body, keywords) for label, confidence, body, keywords in BODIES]
    written += [(label, confidence, template.replace("{n}", _both(name, "licen[cs]e")).replace("{i}", identifier), keywords)
                for template, confidence in CONTEXTS for label, name, identifier, keywords in LICENSES]
    made, by_keyword = [], {}
    for label, confidence, body, keywords in written:
        rule = Rule(len(made), label, re.compile(rf"(?<![a-z0-9]){body}(?![a-z0-9])"), confidence)
        made.append(rule)
        for word in {*keywords.split("|"), *_both(keywords, "licence").split("|")}:
            by_keyword.setdefault(word, []).append(rule.priority)
    automaton = ahocorasick.Automaton()
    for word, numbers in by_keyword.items():
        automaton.add_word(word, tuple(numbers))
    automaton.make_automaton()
    return made, automaton


_RUN = re.compile(r"\s\s+")


def _offsets(text: str, places: list[int]) -> list[int]:
    """Where characters of the text with single blanks stand in ``text`` itself."""
    begin = len(text) - len(text.lstrip())
    at, gone = [0], [begin]  # from position at[i] of the plain text on, gone[i] characters of the text are missing
    for run in _RUN.finditer(text, begin):
        at.append(run.start() - gone[-1] + 1)
        gone.append(gone[-1] + run.end() - run.start() - 1)
    return [place + gone[bisect_right(at, place) - 1] for place in places]


def detections(text: str) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) of what remains in a lower-cased text, by priority.

    Keywords and patterns read the text with each run of white space as one blank; places are those in the text itself.
    Of rules that find the same place the first in order stays; so does the outer one where it comes first.
    """
    made, automaton = rules()
    plain = " ".join(text.split())
    kept: list[tuple[int, int, Rule]] = []
    starts: list[int] = []  # of what is kept, ascending, and the furthest end up to each
    reach: list[int] = []
    for number in sorted({k for _, numbers in automaton.iter(plain) for k in numbers}):
        rule, fresh = made[number], []
        for hit in rule.pattern.finditer(plain):
            start, end = hit.span()
            before = bisect_right(starts, start) - 1
            if before < 0 or reach[before] < end:
                fresh.append((start, end, rule))  # hits of one rule never overlap
        if fresh:
            kept += fresh
            order = sorted((start, end) for start, end, _ in kept)
            starts, reach = [start for start, _ in order], list(accumulate((end for _, end in order), max))
    if not kept or len(plain) == len(text):
        return kept
    starts, lasts = _offsets(text, [s for s, _, _ in kept]), _offsets(text, [e - 1 for _, e, _ in kept])
    return [(start, last + 1, rule) for start, last, (_, _, rule) in zip(starts, lasts, kept)]


# Words are runs of 0-9, a-z (after lower-casing A-Z) and whatever is not ASCII; the rest separates them.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BLANKS = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_PHRASES = [(re.compile(rb"(?<![^ ])" + b" +".join(map(re.escape, phrase.encode().split())) + rb"(?![^ ])"), label)
            for phrase, label in PHRASES]


def places(text: bytes) -> tuple[int, list[tuple[int, str]]]:
    """Number of words, and (word number, label) of every place where the words of a phrase follow each other."""
    plain = text.translate(_WORDS)
    filled = np.frombuffer(plain, dtype=np.uint8) != 32
    starts = filled.copy()
    starts[1:] &= ~filled[:-1]
    hits = [(hit.start(), label) for pattern, label in _PHRASES for hit in pattern.finditer(plain)
            ] if b"license" in plain or b"cc" in plain else []
    if not hits:
        return int(np.count_nonzero(starts)), []
    number = np.cumsum(starts)  # of the word that a byte is in, from 1
    return int(number[-1]), [(int(number[at]) - 1, label) for at, label in hits]


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, n_detections long, spans array<string>")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                    ("n_detections", pa.int64()), ("spans", pa.list_(pa.string()))])


def scan_text(text: bytes) -> tuple:
    n_words, found = places(text)
    base = sorted({label for _, label in found})
    kept = detections(text.translate(_BLANKS).decode("utf-8"))
    labels = sorted({*base, *(rule.label for _, _, rule in kept)})
    score = max([BASE_CONFIDENCE * bool(found), *(rule.confidence for _, _, rule in kept)])
    numbers = [k for k, _ in found]
    return (n_words, len(found), min(numbers, default=None), max(numbers, default=None), ",".join(base), ",".join(labels),
            float(score), len(kept), [f"{rule.label}:{start}-{end}" for start, end, rule in kept])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [scan_text(text) for text in as_bytes(batch.column(1))]
        columns = list(zip(*rows)) if rows else [[]] * 9
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(list(c), kind) for c, kind in zip(columns, _ARROW.types[1:]))], schema=_ARROW)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License labels of every row, in one pass without a shuffle.

    Returns doc_id, n_words, the base phrases (n_base, first_word, last_word, base_labels), labels (base and detected),
    score (confidence of the surest detection; 0 without any), n_detections, spans (label:start-end in code points of
    the lower-cased text). Null and empty texts have no words and no labels. Rows are judged one by one, so ties and
    repeated rows need no rule; null ids pass through.
    """
    prepare(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(_scan, SCHEMA)


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents."""
    return scan(table(spark, sf_dir, "documents")).drop("spans")
