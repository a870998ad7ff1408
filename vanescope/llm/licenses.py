"""License scan by ordered signature rules.

A rule is a pattern over the words of a text, lower-cased and joined by one blank, with a label, a
weight that is its priority, and the keywords without which it cannot match. Rules are made from a
table of licenses and a few forms in which licenses are named, and from sentences of license texts.

* Keyword prefilter. Word hashes of all documents are looked up in the set of keywords; a rule runs
  on a document only if all its keywords are there, and most documents run none.
* Overlaps. Detections are taken by weight, then length, then place. One that lies within the words
  of a detection taken before is suppressed: a short name within a longer one, a general notice
  within a particular one.
* Base phrases are found by word hashes in every document, keyword or not. They are reported apart,
  and nothing suppresses them.

Defined results: a NULL or empty text has no words and no detection. Rows keep their identity.
Overlapping places of one phrase all count.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vanescope.llm.text import ALNUM_WORD, LOWER, Words, chunks

# Phrases that are always reported.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Licenses without versions: label, identifier as words, pattern of the name, keywords.
_SINGLE = (
    ("mit", "mit", "mit license", "mit license"),
    ("mit-0", "mit 0", "mit no attribution(?: license)?", "mit attribution"),
    ("x11", "x11", "x11 license", "x11 license"),
    ("isc", "isc", "isc license", "isc license"),
    ("0bsd", "0bsd", "(?:0bsd|zero clause bsd|bsd zero clause|bsd 0 clause)(?: license)?", ""),
    ("bsd-2-clause", "bsd 2 clause", "(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: license)?", ""),
    ("bsd-3-clause", "bsd 3 clause", "(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: license)?", "bsd"),
    ("bsd-4-clause", "bsd 4 clause", "(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: license)?", "bsd"),
    ("bsd", "bsd", "bsd (?:style )?license", "bsd license"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "(?:wtfpl|do what the fuck you want to public license)", ""),
    ("zlib", "zlib", "zlib license", "zlib license"),
    ("libpng", "libpng", "libpng license", "libpng license"),
    ("boost-1", "bsl 1 0", "boost software license(?: version)?(?: 1 0)?", "boost license"),
    ("postgresql", "postgresql", "postgresql license", "postgresql license"),
    ("openssl", "openssl", "openssl license", "openssl license"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa open source license", "ncsa license"),
    ("w3c", "w3c", "w3c software(?: notice and)? license", "w3c license"),
    ("ruby", "ruby", "ruby license", "ruby license"),
    ("vim", "vim", "vim license", "vim license"),
    ("curl", "curl", "curl license", "curl license"),
    ("json", "json", "json license", "json license"),
    ("beerware", "beerware", "beer ?ware license", "license"),
    ("sleepycat", "sleepycat", "sleepycat license", "sleepycat license"),
    ("ms-pl", "ms pl", "microsoft public license", "microsoft license"),
    ("ms-rl", "ms rl", "microsoft reciprocal license", "microsoft license"),
    ("cc0", "cc0 1 0", "(?:cc0|creative commons zero)(?: license| 1 0| universal)*", ""),
    ("odbl", "odbl 1 0", "(?:open data commons )?open database license", "license"),
    ("pddl", "pddl 1 0", "public domain dedication and license", "license"),
    ("odc-by", "odc by 1 0", "open data commons attribution license", "commons license"),
    ("sspl", "sspl 1 0", "server side public license", "server license"),
    ("elastic-2", "elastic 2 0", "elastic license(?: version)?(?: 2 0)?", "elastic license"),
    ("busl-1.1", "busl 1 1", "business source license(?: version)?(?: 1 1)?", "business license"),
    ("python-2", "python 2 0", "python (?:software foundation )?license", "python license"),
    ("public-domain", "public domain", "public domain", "public domain"),
)

# Licenses with versions: label, identifier, name, keywords, versions.
_VERSIONED = (
    ("gpl", "gpl", "(?:gnu )?(?:general public license|gpl)", "", "1 2 3"),
    ("lgpl", "lgpl", "(?:gnu )?(?:(?:lesser|library) general public license|lgpl)", "", "2 2.1 3"),
    ("agpl", "agpl", "(?:gnu )?(?:affero general public license|agpl)", "", "1 3"),
    ("gfdl", "gfdl", "(?:gnu )?(?:free documentation license|gfdl|fdl)", "", "1.1 1.2 1.3"),
    ("apache", "apache", "apache (?:software )?license", "apache license", "1 1.1 2"),
    ("mpl", "mpl", "(?:mozilla public license|mpl)", "", "1 1.1 2"),
    ("epl", "epl", "(?:eclipse public license|epl)", "", "1 2"),
    ("cddl", "cddl", "(?:common development and distribution license|cddl)", "", "1 1.1"),
    ("artistic", "artistic", "artistic license", "artistic license", "1 2"),
    ("eupl", "eupl", "(?:european union public licen[cs]e|eupl)", "", "1 1.1 1.2"),
    ("cecill", "cecill", "cecill(?: license)?", "cecill", "1 1.1 2 2.1"),
    ("osl", "osl", "(?:open software license|osl)", "", "1 1.1 2 2.1 3"),
    ("afl", "afl", "(?:academic free license|afl)", "", "1.1 1.2 2 2.1 3"),
    ("ofl", "ofl", "(?:sil )?(?:open font license|ofl)", "", "1 1.1"),
    ("lppl", "lppl", "(?:latex project public license|lppl)", "", "1 1.1 1.2 1.3"),
    ("php", "php", "php license", "php license", "3 3.01"),
    ("cpl", "cpl", "(?:common public license|cpl)", "", "1"),
    ("cc-by", "cc by", "(?:cc by|creative commons attribution)(?: license)?", "", "1 2 2.5 3 4"),
    ("cc-by-sa", "cc by sa", "(?:cc by sa|creative commons attribution share ?alike)(?: license)?", "", "1 2 2.5 3 4"),
    ("cc-by-nd", "cc by nd", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?(?: works)?)(?: license)?", "", "1 2 2.5 3 4"),
    ("cc-by-nc", "cc by nc", "(?:cc by nc|creative commons attribution non ?commercial)(?: license)?", "", "1 2 2.5 3 4"),
    ("cc-by-nc-sa", "cc by nc sa", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: license)?", "", "1 2 2.5 3 4"),
    ("cc-by-nc-nd", "cc by nc nd", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?)(?: license)?", "", "1 2 2.5 3 4"),
)

# Sentences that license texts hold: label, pattern, keywords.
_SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission distribute"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary"),
    ("bsd-3-clause", "neither the name of (?:\\S+ ){1,12}nor the names of its contributors may be used", "contributors"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software", "advertising"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free redistribute"),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "free redistribute"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "warranty"),
    ("boost-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "organization"),
    ("no-warranty", "provided as is without warranty of any kind", "warranty"),
    ("no-warranty", "without even the implied warranty of merchantability", "merchantability"),
    ("copyright", "copyright (?:c )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?", "copyright"),
    ("all-rights-reserved", "all rights reserved", "rights reserved"),
    ("proprietary", "proprietary and confidential", "proprietary confidential"),
    ("license-file", "see the license file", "license"),
    ("some-license", "(?:licensed|released|distributed|published|available) under (?:the )?(?:\\S+ ){0,4}licen[cs]e", "under"),
    ("license-terms", "subject to the (?:following )?licen[cs]e terms", "terms"),
)

_GRANT = "(?:licensed|released|distributed|published|available|provided|redistributed)(?: \\S+){0,3} under (?:the )?(?:terms of (?:the )?)?"
_TAG_WEIGHT, _GRANT_WEIGHT, _UNDER_WEIGHT, _TEXT_WEIGHT, _NAME_WEIGHT, _LOOSE_WEIGHT = 1.0, 0.95, 0.9, 0.85, 0.6, 0.3
_LOOSE = {"copyright", "all-rights-reserved", "no-warranty", "license-file", "some-license", "license-terms", "proprietary"}


@dataclass(frozen=True)
class Rule:
    label: str
    weight: float
    keywords: frozenset[str]
    pattern: re.Pattern


def _forms(label: str, tag: str, name: str, keywords: str) -> Iterator[Rule]:
    own = frozenset(keywords.split())
    # Without keywords given, any literal word of the name has to do; the loosest is "license" or an acronym.
    end = "(?= )"
    yield Rule(label, _TAG_WEIGHT, frozenset({"spdx"}), re.compile(f" spdx license identifier {tag}{end}"))
    yield Rule(label, _GRANT_WEIGHT, own | {"under"}, re.compile(f" {_GRANT}{name}{end}"))
    yield Rule(label, _UNDER_WEIGHT, own | {"under"}, re.compile(f" under (?:the )?{name}{end}"))
    yield Rule(label, _NAME_WEIGHT, own, re.compile(f" {name}{end}"))


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, those with the largest weight first."""
    out: list[Rule] = []
    for label, tag, name, keywords in _SINGLE:
        out.extend(_forms(label, tag, name, keywords))
    for label, tag, name, keywords, versions in _VERSIONED:
        out.extend(_forms(label, tag, name, keywords))
        for version in versions.split():
            major, _, minor = version.partition(".")
            number = f"{major} {minor}" if minor else f"{major}(?: 0)?"
            after = f"(?: as published by the free software foundation)?(?: either)?(?: version| v| international| unported)* ?v?{number}"
            later = "(?: or (?:\\(?at your option\\)? )?(?:any )?later(?: version)?| only)?"
            out.extend(_forms(f"{label}-{version}", f"{tag} {number}{later}", f"{name}{after}{later}", keywords))
    for label, sentence, keywords in _SENTENCES:
        weight = _LOOSE_WEIGHT if label in _LOOSE else _TEXT_WEIGHT
        out.append(Rule(label, weight, frozenset(keywords.split()), re.compile(f" {sentence}(?= )")))
    return tuple(sorted(out, key=lambda rule: -rule.weight))


# Words one of which a text must hold for the rules whose names have forms without a common word.
_ANY = frozenset(
    "license licence 0bsd bsd freebsd wtfpl cc0 commons gpl lgpl agpl gfdl fdl mpl epl cddl eupl cecill osl afl ofl lppl cpl cc".split()
)


def _hashes(text: str) -> np.ndarray:
    raw = text.encode()
    return Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM_WORD).hashes


class Scanner:
    """Rules grouped by keywords, and the hashes of keywords and base phrases."""

    def __init__(self) -> None:
        groups: dict[frozenset[str], list[Rule]] = {}
        for rule in rules():
            groups.setdefault(rule.keywords, []).append(rule)
        self.groups = list(groups.items())
        names = sorted(set().union(*groups) | _ANY)
        hashes = np.array([_hashes(name)[0] for name in names])
        order = np.argsort(hashes)
        self.hashes, self.names = hashes[order], [names[i] for i in order]
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(hashes >> np.uint64(48)).astype(np.int64)] = True
        self.base = [(_hashes(phrase), label) for phrase, label in BASE]

    def keywords(self, words: Words) -> dict[int, set[str]]:
        """The keywords of each document that has any."""
        maybe = np.flatnonzero(self.filter[(words.hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, words.hashes[maybe]), len(self.hashes) - 1)
        same = self.hashes[place] == words.hashes[maybe]
        document = np.searchsorted(words.bounds, maybe[same], "right") - 1
        out: dict[int, set[str]] = {}
        for pair in np.unique(document * len(self.names) + place[same]).tolist():
            out.setdefault(pair // len(self.names), set()).add(self.names[pair % len(self.names)])
        return out

    def phrases(self, words: Words) -> dict[int, list[tuple[str, int]]]:
        """Label and first word of every base phrase, by document."""
        out: dict[int, list[tuple[str, int]]] = {}
        n = len(words.hashes)
        for phrase, label in self.base:
            k = len(phrase)
            if n < k:
                continue
            at = np.flatnonzero(words.hashes[: n - k + 1] == phrase[0])
            for j in range(1, k):
                at = at[words.hashes[at + j] == phrase[j]]
            document = np.searchsorted(words.bounds, at, "right") - 1
            inside = at + k <= words.bounds[document + 1]
            for d, i in zip(document[inside].tolist(), at[inside].tolist()):
                out.setdefault(d, []).append((label, i - int(words.bounds[d])))
        return out

    def detect(self, text: str, keywords: set[str]) -> list[tuple[str, float, int, int]]:
        """(label, weight, first word, end word) of what is left of all matches in ``text``, words
        joined by one blank with a blank at either end."""
        found = []
        some = bool(keywords & _ANY)
        for needed, own in self.groups:
            if needed <= keywords and (some or not needed <= {"under"}):
                for rule in own:
                    found.extend((-rule.weight, m.start() - m.end(), m.start(), rule.label, m.end()) for m in rule.pattern.finditer(text))
        if not found:
            return []
        blanks = [m.start() for m in re.finditer(" ", text)]
        taken: list[tuple[int, int]] = []
        out = []
        for weight, _, start, label, end in sorted(found):
            if not any(a <= start and end <= b for a, b in taken):
                taken.append((start, end))
                out.append((label, -weight, bisect_right(blanks, start) - 1, bisect_right(blanks, end - 1)))
        return sorted(out, key=lambda d: d[2:])


@cache
def _scanner() -> Scanner:
    return Scanner()


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``base`` (label, first_word) and ``found`` (label, weight, first_word, end_word)."""
    rows = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    base_kind = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))
    found_kind = pa.list_(pa.struct([("label", pa.string()), ("weight", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner()
        for batch in batches:
            for first, end, data, bounds in chunks(batch.column(1)):
                data = LOWER[data]
                words = Words(data, bounds, ALNUM_WORD)
                base = scanner.phrases(words)
                found: list[list[dict]] = [[] for _ in range(end - first)]
                for document, keywords in scanner.keywords(words).items():
                    a, b = words.bounds[document], words.bounds[document + 1]
                    own = [bytes(data[i:j]) for i, j in zip(words.starts[a:b].tolist(), words.ends[a:b].tolist())]
                    text = (b" " + b" ".join(own) + b" ").decode("utf-8", "replace")
                    found[document] = [
                        {"label": x, "weight": w, "first_word": i, "end_word": j} for x, w, i, j in scanner.detect(text, keywords)
                    ]
                listed = [[{"label": x, "first_word": i} for x, i in base.get(d, ())] for d in range(end - first)]
                yield pa.record_batch(
                    [batch.column(0).slice(first, end - first), pa.array(words.counts.astype(np.int64)), pa.array(listed, base_kind), pa.array(found, found_kind)],
                    names=["id", "n_words", "base", "found"],
                )

    place = [T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType())]
    match = [place[0], T.StructField("weight", T.DoubleType()), place[1], T.StructField("end_word", T.LongType())]
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("base", T.ArrayType(T.StructType(place))),
            T.StructField("found", T.ArrayType(T.StructType(match))),
        ]
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
