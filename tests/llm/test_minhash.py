import random
import re

from awkward_rows import AWKWARD

from vanescope.llm import minhash
from vanescope.llm.components import connected_components


def shingles(text):
    raw = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows, percent=85):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def linked(a, b):
        return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if any(linked(x, y) for x in sets[i] for y in sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def check(df, rows):
    got = minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = expected(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is not None and r.doc_id == want[r.doc_id])
    assert sorted(r.n_shingles for r in got) == sorted(len(shingles(t)) for _, t in rows)


def family(pick, base, changes, n):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(pick.randint(0, changes)):
            at = pick.randrange(len(words))
            words[at : at + pick.randint(0, 1)] = [pick.choice("uvwxyz") * pick.randint(1, 3)]
        out.append(" ".join(words))
    return out


def test_awkward_tables(awkward, empty):
    check(awkward, AWKWARD)
    assert minhash.near_duplicates(empty).count() == 0


def test_near_copies_equal_brute_force(documents, monkeypatch):
    pick = random.Random(3)
    texts = []
    for size, changes in ((60, 3), (200, 12), (30, 1)):
        texts += family(pick, [f"w{pick.randrange(5000)}" for _ in range(size)], changes, 60)
    texts += texts[:25]
    pick.shuffle(texts)
    rows = list(enumerate(texts))
    # Small blocks, so that members of one centre are compared across blocks.
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "MEMBERS_PER_CENTRE", 4)
    check(documents(rows), rows)


def test_members_are_linked_without_their_centre(documents):
    # The centre is close to neither of two texts that are equal but for one word.
    pick = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    other = base[:100] + [f"x{i}" for i in range(30)] + base[130:]
    near = list(other)
    near[150] = "changed"
    rows = list(enumerate([" ".join(base), " ".join(other), " ".join(near), *family(pick, base, 1, 20)]))
    check(documents(rows), rows)


def test_links_between_equals_pairwise_test():
    import numpy as np

    random_ = np.random.default_rng(5)
    sides = [[np.unique(random_.integers(0, 60, random_.integers(1, 60)).astype(np.uint64)) for _ in range(40)] for _ in range(2)]
    got = set(zip(*(x.tolist() for x in minhash.links_between(*sides))))
    assert got == {(i, j) for i, x in enumerate(sides[0]) for j, y in enumerate(sides[1]) if minhash.similar(x, y)}


def test_components(spark):
    pick = random.Random(6)
    edges = [(pick.randrange(200), pick.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(None, 1), (5, None)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            root.setdefault(a, a)
            root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in root and b in root and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def packed_texts(spark, texts):
    from vanescope.llm.packed import packed

    return packed(spark.createDataFrame(list(enumerate(texts)), "id long, text string"))


def test_prefixes_lose_no_link(spark, monkeypatch):
    pick = random.Random(8)
    texts = []
    for size, changes in ((12, 2), (40, 4), (120, 14), (200, 6)):
        texts += family(pick, [f"w{pick.randrange(400)}" for _ in range(size)], changes, 40)
    texts += ["", "one", "one", "a b c d", "a b c d e"]
    sets = [shingles(t) for t in texts]
    # Any order of the shingles will do, also one by few counters.
    for percent, bits in ((80, 20), (85, 2), (95, 20)):
        monkeypatch.setattr(minhash, "COUNTER_BITS", bits)
        linked = {
            (i, j) for j, y in enumerate(sets) for i, x in enumerate(sets[:j]) if x and y and 100 * len(x & y) >= percent * len(x | y)
        }
        no_roots = spark.createDataFrame([], "node long, root long")
        found = {(r.a, r.b) for r in minhash.pairs_by_prefix(packed_texts(spark, texts), no_roots, percent).collect()}
        assert linked <= found and len(linked) > 20
        # Those of one component are not paired.
        together = spark.createDataFrame([(i, 0) for i in range(len(texts))], "node long, root long")
        assert minhash.pairs_by_prefix(packed_texts(spark, texts), together, percent).count() == 0


def test_pages_of_one_template_make_no_pairs(spark, documents):
    pick = random.Random(9)
    template = [f"t{i}" for i in range(150)]
    # Alike to about 0.59: they meet in buckets, and none is linked.
    texts = [" ".join(template[:70] + [f"own{pick.randrange(10**9)}" for _ in range(50)] + template[70:]) for _ in range(600)]
    no_roots = spark.createDataFrame([], "node long, root long")
    assert minhash.pairs_by_prefix(packed_texts(spark, texts), no_roots, 85).count() == 0
    assert minhash.pairs_by_prefix(packed_texts(spark, texts), no_roots, 80).count() == 0
    # With copies of some of them that differ in a word.
    copies = [t.replace("t3 ", "changed ", 1) for t in texts[:40]]
    rows = list(enumerate(texts[:200] + copies))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(documents(rows)).collect()}
    assert got == {i: i if i < 200 else i - 200 for i, _ in rows}
