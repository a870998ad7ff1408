import random
import re

from awkward_rows import AWKWARD

from vanescope.llm import repeats


def expected(rows):
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        if i is not None:
            for j in range(len(w) - 12):
                key = tuple(w[j : j + 13])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        if i is not None:
            for j in range(len(w) - 12):
                if first[tuple(w[j : j + 13])] < i:
                    gone[j : j + 13] = [True] * 13
        out.append((str(i), len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in repeats.remove_repeats(df).collect())


def passages():
    pick = random.Random(7)
    vocabulary = [f"v{i}" for i in range(40)]
    shared = [[pick.choice(vocabulary) for _ in range(n)] for n in (12, 13, 14, 20, 60, 200)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(pick.randint(1, 6)):
            words += pick.choice(shared)[pick.randint(0, 5) :] if pick.random() < 0.5 else [pick.choice(vocabulary) for _ in range(pick.randint(1, 40))]
        rows.append((i % 100, pick.choice([" ", "\n", " \t"]).join(words)))
    return rows


def test_awkward_tables(awkward, empty):
    assert found(awkward) == expected(AWKWARD)
    assert repeats.remove_repeats(empty).count() == 0
    assert repeats.cut_repeats(empty).columns == empty.columns


def test_passages_equal_brute_force(documents):
    rows = passages()
    assert found(documents(rows)) == expected(rows)


def test_cut_keeps_rows_and_columns(documents):
    rows = passages()
    df = documents(rows)
    got = repeats.cut_repeats(df)
    assert got.schema == df.schema
    cut = {(i, kept) for i, _, gone, kept in expected(rows) if gone}
    whole = {(str(i), t) for i, t in rows}
    for r in got.collect():
        assert r.n_chars == len(r.text)
        assert (str(r.doc_id), r.text) in whole | cut
    assert {(str(r.doc_id), r.text) for r in got.collect()} >= cut
