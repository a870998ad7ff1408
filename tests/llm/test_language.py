import math

import numpy as np
from awkward_rows import AWKWARD

from vanescope.llm import language

TEXTS = {
    "en": "the quick brown fox jumps over the lazy dog and the cat sat on the mat with another thing that this one had",
    "fr": "le renard brun saute par dessus le chien paresseux et la souris est dans la maison avec une autre chose où été",
    "de": "der schnelle braune fuchs springt über den faulen hund und die katze sitzt auf der matte mit einer anderen sache",
}


def training(spark):
    rows = []
    for k, (lang, text) in enumerate(TEXTS.items()):
        words = text.split()
        rows += [(1000 * k + i, " ".join(words[i % 9 :] + words[: i % 9]), lang) for i in range(30)]
    return spark.createDataFrame([*rows, (1, None, "en"), (2, "text", None), (None, "le chien", "fr")], "doc_id long, text string, lang string")


def plain_code_length(samples, text, order, used):
    """Bits by a direct walk through counts of all contexts."""
    counts = {}
    for sample in samples:
        data = bytes(order) + sample.encode()
        for at in range(order, len(data)):
            for k in range(order + 1):
                node = counts.setdefault(data[at - k : at], {})
                node[data[at]] = node.get(data[at], 0) + 1
    data = bytes(order) + text.encode()
    total = 0.0
    for at in range(order, len(data)):
        for k in range(order, -1, -1):
            node = counts.get(data[at - k : at])
            if not node:
                continue
            n, kinds = sum(node.values()), len(node)
            if data[at] in node:
                total += math.log2((n + kinds) / node[data[at]])
                break
            total += math.log2((n + kinds) / kinds)
        else:
            total += 8
    return total


def test_code_lengths_are_exact(spark, monkeypatch):
    monkeypatch.setattr(language, "LEAST_SEEN", 1)
    df = training(spark)
    model = language.train(df)
    assert model.langs == sorted(TEXTS)
    samples = {lang: [r.text for r in df.where("lang = '%s' AND text IS NOT NULL" % lang).collect()] for lang in TEXTS}
    for text in ("the fox", "être à la maison", "zzz qqq", "x", "\x00Ω the"):
        raw = text.encode()
        bits = model.code_lengths(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        want = [plain_code_length(samples[lang], text, language.ORDER, None) for lang in model.langs]
        assert np.allclose(bits, want, rtol=1e-5)


def test_documents_of_a_chunk_are_independent(spark):
    model = language.train(training(spark))
    texts = ["the dog", "", "le chien", "x", "der hund und die katze"]
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    together = model.code_lengths(np.frombuffer(b"".join(raw), np.uint8), bounds)
    for i, r in enumerate(raw):
        alone = model.code_lengths(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert np.allclose(together[i], alone)


def test_awkward_tables(spark, awkward, empty):
    model = language.train(training(spark))
    rows = language.identify(awkward, model).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert 0 <= r.score <= 1
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3))
    assert by[9].lang_pred == "de" or by[9].score < 1
    assert language.identify(empty, model).count() == 0
    untrained = language.train(empty)
    assert {r.lang_pred for r in language.identify(awkward, untrained).collect()} == {"und"}
    kept = language.with_language(awkward, model, "found")
    assert kept.columns == [*awkward.columns, "found"] and kept.count() == len(AWKWARD)


def test_held_out_accuracy(spark):
    from vanescope.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = queries.op6_language(spark, sf_dir).where("held_out").join(lang, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)


def test_languages_of_one_long_text_are_learned(spark):
    rows = [(i, (text + " ") * 2000, lang) for i, (lang, text) in enumerate(TEXTS.items())]
    rows += [(100 + i, text, lang) for i, (lang, text) in enumerate(TEXTS.items())]
    df = spark.createDataFrame([*rows, (None, "ein satz " * 9, "xx")], "doc_id long, text string, lang string")
    model = language.train(df, sample_bytes=4000)
    assert model.langs == sorted([*TEXTS, "xx"])
    got = {r.doc_id: r.lang_pred for r in language.identify(df, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_pieces_make_up_the_text(monkeypatch):
    raw = [b"some text of a document", b"", b"and another one, cut into pieces"]
    data, bounds = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])
    whole = language._pieces(data, bounds, [[0], [0], [0]])
    monkeypatch.setattr(language, "PIECE_BYTES", 5)
    cut = language._pieces(data, bounds, [list(range(5)), [0], list(range(7))])
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all() and len(whole[0]) == len(data)
