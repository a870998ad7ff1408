import re

from awkward_rows import AWKWARD

from vanescope.llm import licenses

TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the License)",
    "under the MIT license. Under the, MIT; license!",
    "CC-BY-NC-SA 4.0 and cc by nc",
    "SPDX-License-Identifier: GPL-3.0-or-later",
    "This is licensed under the terms of the GNU General Public License version 2 or later. All rights reserved.",
    "GNU Lesser General Public License v2.1",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mit freundlichen Grüßen unter der Lizenz",
    "under the mit" + " license",
    "épée under the mit license",
]


def test_labels():
    scanner = licenses.Scanner()

    def labels(text):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return {d[0] for d in scanner.detect(" " + " ".join(words) + " ", set(words))}

    assert labels(TEXTS[0]) == {"apache-2"}
    assert labels(TEXTS[1]) == {"mit"}
    assert labels(TEXTS[2]) == {"cc-by-nc-sa-4", "cc-by-nc"}
    assert labels(TEXTS[3]) == {"gpl-3"}
    assert labels(TEXTS[4]) == {"gpl-2", "all-rights-reserved"}
    assert labels(TEXTS[5]) == {"lgpl-2.1"}
    assert labels(TEXTS[6]) == {"mit"}
    assert labels(TEXTS[7]) == set()


def test_base_phrases_equal_brute_force(documents, awkward, empty):
    rows = [*enumerate(TEXTS * 2), *AWKWARD]
    got = licenses.scan(documents(rows)).collect()
    want = []
    for i, t in rows:
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        places = [
            (label, k) for phrase, label in licenses.BASE for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.encode().split()
        ]
        want.append(str((str(i), len(words), sorted(places))))
    assert sorted(str((str(r.doc_id), r.n_words, sorted((b.label, b.first_word) for b in r.base))) for r in got) == sorted(want)
    assert licenses.scan(empty).count() == 0


def test_rules_run_only_with_their_keywords():
    assert len(licenses.rules()) > 300
    scanner = licenses.Scanner()
    assert scanner.detect(" apache license version 2 0 ", {"license"}) == []
    weights = [rule.weight for rule in licenses.rules()]
    assert weights == sorted(weights, reverse=True)
