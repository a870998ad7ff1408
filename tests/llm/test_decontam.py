import random
import re

import numpy as np
import pytest
from awkward_rows import AWKWARD

from vanescope.llm import decontam
from vanescope.llm.text import ALNUM_WORD, Words


def words_of(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def nearest_run(item, words):
    """(distance, first word, words) of the run of words nearest to the item; the first, then the shortest."""
    # Each cell: distance so far and the place where its run starts.
    row = [(0, j) for j in range(len(words) + 1)]
    for x in item:
        new = [(row[0][0] + 1, 0)]
        for j, y in enumerate(words):
            new.append(min((row[j][0] + (x != y), row[j][1]), (row[j + 1][0] + 1, row[j + 1][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    least, end = min((cell, j) for j, cell in enumerate(row))
    return least[0], least[1], end - least[1]


def is_near(item, words):
    """Whether a run of words is a leak of the item."""
    # A leak lacks as many of the item's words as there may be edits, at most.
    n = len(item)
    return len(set(words) & set(item)) >= len(set(item)) - n // 5 and nearest_run(item, words)[0] <= n // 5


def expected(rows, items):
    out = {}
    for d, (i, t) in enumerate(rows):
        w = words_of(t)
        for item, text in items:
            m = words_of(text)
            if item is not None and text is not None and len(m) >= 8 and is_near(m, w):
                out[(d, item)] = nearest_run(m, w)
    return out


@pytest.fixture(scope="module")
def case():
    pick = random.Random(10)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(i, " ".join(pick.choices(vocabulary, k=pick.randint(8, 45)))) for i in range(25)] + [(90, None), (None, "a b c d e f g h i"), (91, "too short")]
    rows = []
    for i in range(160):
        words = pick.choices(vocabulary, k=pick.randint(5, 120))
        if i % 2:
            own = items[pick.randrange(25)][1].split()
            for _ in range(pick.randint(0, max(0, len(own) // 5 - 1))):
                at = pick.randrange(len(own))
                own[at : at + pick.randint(0, 1)] = pick.choices(vocabulary, k=pick.randint(0, 1))
            at = pick.randrange(len(words))
            words[at:at] = own
        rows.append((i, pick.choice([" ", ", ", "\n"]).join(words).title()))
    return rows, items


def test_recall_and_exactness(spark, documents, case):
    rows, items = case
    leaks = decontam.find_leaks(documents(rows), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.distance, r.first_word, r.n_words) for r in leaks.collect()}
    want = expected(rows, items)
    assert set(got) <= set(want)
    assert len(got) >= 0.95 * len(want) > 50
    # Where a leak is found, so is its best run.
    assert all(v == want[k] for k, v in got.items())


def test_short_items_are_found_where_their_words_stand(spark, documents):
    pick = random.Random(13)
    texts = [[f"v{pick.randrange(40)}" for _ in range(pick.randrange(60))] for _ in range(80)]
    items = [(100 * n + k, [f"v{pick.randrange(40)}" for _ in range(n)]) for n in (1, 2, 3, 5, 7) for k in range(6)]
    for item, words in items[::2]:
        at = pick.randrange(80)
        texts[at] = [*texts[at], *words, "end"]
    table = [(i, " ".join(words).upper()) for i, words in items]
    table += [table[0], (None, "v1"), (9, None), (9, " - ")]
    leaks = decontam.find_leaks(documents([(i, ", ".join(words)) for i, words in enumerate(texts)]), spark.createDataFrame(table, "item_id long, text string"))
    got = sorted((r.doc_id, r.item_id, r.first_word, r.n_words, r.distance) for r in leaks.collect())
    want = []
    for i, words in enumerate(texts):
        for item, own in items:
            places = [j for j in range(len(words) - len(own) + 1) if words[j : j + len(own)] == own]
            want += [(i, item, places[0], len(own), 0)] if places else []
    assert got == sorted(want) and {r[1] // 100 for r in got} == {1, 2, 3, 5, 7}


def test_slices_give_the_same(spark, documents, case, monkeypatch):
    rows, items = case
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in decontam.find_leaks(documents(rows), table).collect()}
    monkeypatch.setattr(decontam, "SLICE_BYTES", 1500)
    sliced = {(r.doc_id, r.item_id) for r in decontam.find_leaks(documents(rows), table).collect()}
    assert len(whole ^ sliced) <= 0.05 * len(whole)


def test_awkward_tables(spark, awkward, empty):
    items = spark.createDataFrame([(1, "A, b c d e f g H i j"), (2, "word " * 20), (2, "word " * 20)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(awkward, items).collect()}
    assert got == {(5, 1), (6, 1), (None, 1), (10, 1), (7, 2)}
    assert decontam.find_leaks(empty, items).count() == 0
    assert decontam.find_leaks(awkward, items.limit(0)).count() == 0
    assert len(AWKWARD) == awkward.count()


def test_distances_equal_plain_ones():
    random_ = np.random.default_rng(11)
    x, y = random_.integers(0, 4, (50, 12)), random_.integers(0, 4, (50, 12))
    assert decontam.distances(x, y).tolist() == [distance(a, b) for a, b in zip(x.tolist(), y.tolist())]


def test_equal_windows_have_equal_walks():
    raw = b"a b c d e f g h a b c d e f g h"
    words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM_WORD)
    walks = decontam.embed(words.hashes, np.array([0, 8, 1]), np.array([8, 8, 8]))
    assert (walks[0] == walks[1]).all() and (walks[0] != walks[2]).any()


def edited(pick, own):
    """A copy with as many edits of all kinds as make a leak at most."""
    own = list(own)
    for k in range(len(own) // 5):
        at, kind = pick.randrange(len(own)), pick.randrange(3)
        own[at : at + (kind != 1)] = [f"new{k}"] if kind != 2 else []
    return own


def joined(texts):
    raw = [t.encode() for t in texts]
    return Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]), ALNUM_WORD)


def share_found(pick, sizes, trials, others=()):
    """Share of edited copies, inside of documents, that the items of these sizes are found in."""
    items = [[f"i{k}w{pick.randrange(2000)}" for _ in range(n)] for k, n in enumerate(sizes)]
    index = decontam.Index([*range(len(items)), *range(10_000, 10_000 + len(others))], [" ".join(x) for x in [*items, *others]])
    want, texts = set(), []
    for k, own in enumerate(items):
        for _ in range(trials):
            want.add((len(texts), k))
            around = [[f"f{pick.randrange(5000)}" for _ in range(100)] for _ in range(2)]
            texts.append(" ".join([*around[0], *edited(pick, own), *around[1]]) + "\n")
    document, item = index.leaks(joined(texts))[:2]
    return len(want & set(zip(document.tolist(), item.tolist()))) / len(want)


@pytest.mark.parametrize("n", (15, 20, 30, 59))
def test_copies_with_edits_of_all_kinds_are_found(n):
    assert share_found(random.Random(n), [n] * 8, 15) >= 0.95


def test_documents_shorter_than_the_item_are_searched():
    items = [[f"i{k}w{j}" for j in range(20)] for k in range(6)]
    index = decontam.Index(list(range(6)), [" ".join(x) for x in items])
    # Whole documents: the item less a word or less four; or its end cut off by the document's end.
    texts = [" ".join(x[:7] + x[8:]) for x in items[:2]] + [" ".join(x[2:-2]) for x in items[2:4]] + ["a b c " + " ".join(x[:-3]) for x in items[4:]]
    document, item, first, size, distance = index.leaks(joined([t + "\n" for t in texts]))
    got = list(zip(*(x.tolist() for x in (document, item, first, size, distance))))
    assert got == [(0, 0, 0, 19, 1), (1, 1, 0, 19, 1), (2, 2, 0, 16, 4), (3, 3, 0, 16, 4), (4, 4, 3, 17, 3), (5, 5, 3, 17, 3)]


def test_best_runs_equal_plain_ones():
    pick = random.Random(12)
    x = [[pick.randrange(5) for _ in range(7)] for _ in range(30)]
    y = [[pick.randrange(5) for _ in range(14)] for _ in range(30)]
    size = [pick.randint(5, 14) for _ in range(30)]
    got = list(zip(*(v.tolist() for v in decontam.best_runs(np.array(x), np.array(y), np.array(size)))))
    for a, b, n, run in zip(x, y, size, got):
        assert run == min((distance(a, b[s:e]), s, e) for s in range(n + 1) for e in range(s, n + 1))


@pytest.mark.parametrize("n", (100, 200, 400, 800))
def test_long_items_are_found_among_short_ones(n):
    pick = random.Random(7)
    short = [[f"s{pick.randrange(5000)}" for _ in range(pick.randint(10, 59))] for _ in range(200)]
    assert share_found(random.Random(n), [n] * 3, 6, short) >= 0.95
