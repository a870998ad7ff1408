import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from awkward_rows import AWKWARD

from vanescope.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def codec(ranks):
    return bpe.Codec(ranks)


@pytest.fixture(scope="module")
def decoder(ranks):
    return bpe.Decoder(ranks)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_equals_the_library_on_random_texts(codec, decoder, library):
    pick = random.Random(1)
    parts = [" ", "  ", "\n", "'", "'s", "'ll", "'re", "a", "é", "ß", "1", "٣", "。", "😀", "\t", "\xa0", "\x85", "the", "!!", "’", "中", "\x1c"]
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 40))) for _ in range(3000)]
    for text, packed in zip(texts, codec.encode(texts)):
        assert ids(packed) == library.encode_ordinary(text), text
        assert decoder.decode(packed) == text.encode()


def test_every_kind_of_character(codec, library):
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)} x\n{chr(c)}" for c in range(0, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    for text, packed in zip(texts, codec.encode(texts)):
        assert ids(packed) == library.encode_ordinary(text), text


def test_long_pre_token_and_reuse(codec, library):
    text = "xq" * 100_000
    for _ in range(2):
        assert ids(codec.encode([text])[0]) == library.encode_ordinary(text)
    assert all(len(token) <= bpe.KNOWN_CHARS for token in codec.young)


def test_vocabulary_in_which_a_longer_token_has_a_smaller_rank():
    ranks = {bytes([b]): 1000 + b for b in range(256)} | {b"ab": 500, b"abc": 3, b"cd": 400, b"bc": 450, b"abcd": 2}
    merger = bpe.Merger(ranks)
    assert not merger.grown

    def by_scan(token):
        parts = [token[i : i + 1] for i in range(len(token))]
        while True:
            found = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not found:
                return [ranks[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    pick = random.Random(2)
    tokens = ["".join(pick.choices("abcd", k=pick.randint(1, 20))).encode() for _ in range(500)]
    assert [ids(p) for p in merger.merge(tokens)] == [by_scan(t) for t in tokens]


def test_awkward_tables(spark, awkward, empty, library):
    rows = bpe.decode(bpe.encode(awkward, PATH), PATH).collect()
    assert len(rows) == len(AWKWARD)
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in AWKWARD)
    assert sorted((str(r.doc_id), ids(r.ids), bytes(r.decoded)) for r in rows) == want
    assert bpe.decode(bpe.encode(empty, PATH), PATH).count() == 0
