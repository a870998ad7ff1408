import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
import tokenizers
from awkward_rows import AWKWARD

from vanescope.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def token_bytes_b(b, i):
    return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()


def token_bytes_a(a, i):
    # The library's own decoder of bytes, on as many copies as make bytes whole characters.
    shown = a.id_to_token(i)
    back = {c: n for n, c in tokenizers_alphabet().items()}
    return bytes(back[c] for c in shown)


def tokenizers_alphabet():
    # Written by the library itself: the characters it shows for each byte of some text.
    if not hasattr(tokenizers_alphabet, "known"):
        plain = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        known = {}
        for code in [*range(0x80), *range(0x80, 0x800), *range(0x800, 0xD800, 61), *range(0x10000, 0x110000, 4093)]:
            for n, c in zip(chr(code).encode(), plain.pre_tokenize_str(chr(code))[0][0]):
                known[n] = c
        tokenizers_alphabet.known = known
    return tokenizers_alphabet.known


def plain(libraries, text):
    """(ids of A, ids of B, groups, linked id pairs with their numbers) of a whole text, token by token."""
    a, b = libraries
    if not text:
        return [], [], [], Counter()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a, raw_b = [token_bytes_a(a, i) for i in ids_a], [token_bytes_b(b, i) for i in ids_b]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return [], [], [], Counter()
    groups, links, i, j = [], Counter(), 0, 0
    own_a, own_b, end_a, end_b = [], [], 0, 0
    spans_a, spans_b = [], []
    for ids, raws, spans in ((ids_a, raw_a, spans_a), (ids_b, raw_b, spans_b)):
        at = 0
        for n, r in zip(ids, raws):
            spans.append((at, at + len(r), n))
            at += len(r)
    while i < len(spans_a) or j < len(spans_b):
        if end_a <= end_b and i < len(spans_a):
            own_a.append(spans_a[i])
            end_a = spans_a[i][1]
            i += 1
        else:
            own_b.append(spans_b[j])
            end_b = spans_b[j][1]
            j += 1
        if end_a == end_b:
            groups.append(([x[2] for x in own_a], [x[2] for x in own_b]))
            for s, e, x in own_a:
                for t, f, y in own_b:
                    if max(s, t) < min(e, f):
                        links[(x, y)] += 1
            own_a, own_b = [], []
    return ids_a, ids_b, groups, links


def expected(libraries, rows):
    own = [(i, *plain(libraries, t)) for i, t in rows]
    count = Counter(pair for *_, links in own for pair in links)
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for i, a, b, groups, links in own:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                i, len(a), len(b), len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == highest[p[0]]),
                sum(n * count[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=repr), {(x, y, n, n == highest[x]) for (x, y), n in count.items()}


def found(df):
    rows = df.collect()
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in rows), key=repr)


def test_byte_values_are_those_of_the_library():
    values = alignment.byte_level_values()
    assert sorted(values.values()) == list(range(256))
    assert all(values[c] == n for n, c in tokenizers_alphabet().items())


def test_query_equals_brute_force(spark, libraries):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(queries.QUERIES["op12_alignment"](spark, sf_dir)) == expected(libraries, rows)[0]


def strange(pick, n):
    parts = ["word", " ", "  ", "\n", "\n\n ", "\t", "é", "漢字", "😀", "▁", "<|endoftext|>", "<s>", "\x00", "\u00a0", "\u2028", "'s", "12", ".,", "…", "\x1c ", "\u0085 a"]
    return [(i, "".join(pick.choices(parts, k=pick.randint(0, 25)))) for i in range(n)]


def test_strange_texts_small_runs_and_slices(spark, documents, libraries, monkeypatch):
    rows = strange(random.Random(12), 400) + [(1000 + i, "the the the, of the") for i in range(100)]
    table = documents(rows).repartition(5)
    want, pairs = expected(libraries, rows)
    assert any(w[1] for w in want) and any(not w[1] for w in want)
    assert found(alignment.align(table, A, B)) == want
    # Tasks are other processes; what they are to know goes with the function.
    monkeypatch.setattr(alignment, "RUNS_PER_SLICE", 2)
    assert found(alignment.align(table, A, B)) == want
    assert {tuple(r) for r in alignment.pair_counts(table, A, B).collect()} == pairs


def test_awkward_tables(documents, awkward, empty, libraries):
    assert found(alignment.align(awkward, A, B)) == expected(libraries, AWKWARD)[0]
    assert found(alignment.align(empty, A, B)) == []
    assert found(alignment.align(documents([(1, None), (2, "")]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_a_small_memory_of_segments_gives_the_same(libraries, monkeypatch):
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        both = alignment.Tokenizers(a.read(), b.read())
    assert both.cuts
    texts = [t for _, t in strange(random.Random(5), 300) if t] + ["x" * 5000]
    results = []
    for limit, longest, cuts in ((10**6, 10**6, True), (40, 5, True), (10**6, 10**6, False)):
        monkeypatch.setattr(alignment, "KNOWN_SEGMENTS", limit)
        monkeypatch.setattr(alignment, "LONGEST_KNOWN", longest)
        both.cuts = cuts
        known = alignment.Segments(both)
        parts = [known.of([both.segments(t) for t in texts[at : at + 7]]) for at in range(0, len(texts), 7)]
        results.append([np.concatenate([p[k] for p in parts]).tolist() for k in (0, 1, 2, 4)])
        # Without cuts links come in the same order as well.
        results[-1].append(np.concatenate([p[3] for p in parts]).tolist())
    assert results[0] == results[1] == results[2]


def test_runs_merge_and_arrays_come_back():
    random_ = np.random.default_rng(7)
    pairs = random_.integers(0, 50, 3000) << 20 | random_.integers(0, 40, 3000)
    documents = random_.integers(0, 60, 3000)
    want = Counter(zip(pairs.tolist(), documents.tolist()))
    got, runs = {}, []
    for radix, piece in alignment.sorted_run(pairs, documents):
        steps, n, document, links = alignment.load(piece)
        own = np.cumsum(steps)
        assert (np.diff(own) > 0).all() and set((own >> 20) % 16) == {radix}
        runs.append((own, n))
        got |= {(p, d): k for p, d, k in zip(np.repeat(own, n).tolist(), document.tolist(), links.tolist())}
    assert got == want
    assert dict(alignment.merged(runs + runs)) == {p: 2 * n for p, n in Counter(p for p, _ in want).items()}
    for a in ([], [0], [255, 256], [1 << 40, 0]):
        assert alignment.load(alignment.dump(np.array(a, np.int64)))[0].tolist() == a
