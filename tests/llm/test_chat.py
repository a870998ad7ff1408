import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vanescope.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, ids string, formatted int, loss_runs double"

pieces = st.sampled_from([*chat.CONTROL, "\\", "<", "[", "|", "s>", "/", "SYS>>", "im_end|>", " ", "\n", "a", "é", "漢", "😀", "\x00", "INST]"])
texts = st.lists(pieces, max_size=12).map("".join) | st.text(max_size=20)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return chat.Encoder(file.read())


@given(texts)
@settings(max_examples=500, deadline=None)
def test_escape_is_reversible_and_complete(text):
    own = chat.escaped(text)
    assert chat.unescaped(own) == text
    assert not any(c in own for c in chat.CONTROL)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "<|im_sep|>"]) | texts, texts), max_size=6))
@settings(max_examples=300, deadline=None)
def test_round_trip(encoder, turns):
    one = chat.render(turns)
    assert chat.parse(one.text) == turns
    (ids, starts, ends), = encoder.encode([one.text])
    runs = chat.runs_of_tokens(starts, ends, one.spans)
    assert chat.masked_text(one.text, starts, ends, runs) == "".join(t for r, t in turns if r == "assistant")
    # By plain comparison: a token is learned if it lies in a learned text.
    mask = [any(a <= s and e <= b for a, b in one.spans) and s < e for s, e in zip(starts, ends)]
    assert mask == [any(a <= i < b for a, b in runs) for i in range(len(ids))]
    # Marks are the only special tokens, three for each turn.
    assert sum(i >= 50257 for i in ids) == 3 * len(turns) and 50256 not in ids
    plain = encoder.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
    assert plain == one.text


def test_parse_rejects_what_is_no_conversation():
    for text in ("x", chat.START, f"{chat.START}user{chat.SEPARATOR}a", f"{chat.START}a{chat.SEPARATOR}b{chat.END}\nx"):
        with pytest.raises(ValueError):
            chat.parse(text)


def brute_force(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: [(x is not None, x or 0 if i == 1 else x or "") for i, x in enumerate(r)])
        turns = [(r[2] or "", r[3] or "") for r in own]
        out[conv] = (turns, "".join(t for r, t in turns if r == "assistant"), len(chat.render(turns).text))
    return out


def found(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA).repartition(parts)
    got = chat.read_back(chat.format_conversations(df, PATH)).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text, r.formatted_chars) for r in got}


def test_tables_equal_brute_force(spark, monkeypatch):
    pick = random.Random(13)
    rows = []
    for conv in range(60):
        for turn in range(pick.randint(1, 12)):
            text = "".join(pick.choices([*chat.CONTROL, "word ", "Größe ", "漢字", "\n", "\\"], k=pick.randint(0, 30)))
            rows.append((conv, turn, pick.choice(["user", "assistant", "system"]), text))
    # One conversation with a third of all rows, out of order.
    rows += [(999, turn, "assistant" if turn % 2 else "user", f"turn {turn}") for turn in range(200)]
    pick.shuffle(rows)
    assert found(spark, rows) == brute_force(rows)


def test_awkward_rows(spark):
    rows = [
        (1, 0, None, None), (1, 0, None, "x"), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, None, "assistant", "first"), (2, 0, "assistant", None),
        (None, 1, "assistant", "b"), (None, 0, "user", "a"), (3, 0, "assistant", "long " * 60_000), (4, 0, "ASSISTANT", "not learned"), (5, 0, "a\nb<|im_sep|>", "\r\n"),
        (6, 0, "assistant", ""), (6, 1, "assistant", " "), (6, 2, "assistant", "é"),
    ]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, []) == {}


def test_output_is_what_a_trainer_needs(spark, encoder):
    rows = [(1, 0, "user", "Hi <|im_end|>"), (1, 1, "assistant", "漢字 ok")]
    row = chat.format_conversations(spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA), PATH).first()
    assert row.formatted == "<|im_start|>user<|im_sep|>Hi <\\|im_end|><|im_end|>\n<|im_start|>assistant<|im_sep|>漢字 ok<|im_end|>\n"
    (first, end), = row.loss_runs
    assert encoder.tokenizer.decode(row.ids[first:end]) == "漢字 ok"
    assert np.all(np.diff(row.starts) >= 0) and np.all(np.diff(row.ends) >= 0)
