import sys
from pathlib import Path

import pytest
from awkward_rows import AWKWARD

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline  # noqa: E402
from oracle import duck, mismatch  # noqa: E402
from vanescope.llm import queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert mismatch(queries.QUERIES[name](spark, SF_DIR), duck(SF_DIR), queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR).collect()
    assert name == "op10_leaks" or len(rows) == 200


def test_stages_follow_from_their_operators(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "substrings":
            assert all(after[i] == before[i] for i in after)
        docs = spark.createDataFrame(list(after.values()), docs.schema)
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()


def test_awkward_documents(spark, awkward, empty):
    for df in (awkward, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, SF_DIR)
            assert df.columns == awkward.columns
            df = spark.createDataFrame(df.collect(), awkward.schema)
        tokens = corpus_pipeline.STAGES[-1][1](spark, df, SF_DIR)
        assert tokens.count() == df.count() <= len(AWKWARD)


def test_result_equals_brute_force(spark):
    import hashlib

    import public_tokenizers
    import test_decontam
    import test_minhash
    import test_repeats
    import tiktoken

    from vanescope.llm import bpe

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [(r.item_id, test_decontam.words_of(r.text)) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    docs = [(i, t) for i, t in docs if t and any(c.isalpha() for c in t)]
    component = test_minhash.expected(docs, corpus_pipeline.NEAR_PERCENT)
    docs = [(i, t) for i, t in docs if component[i] == i]
    cut = {int(i): kept for i, _, gone, kept in test_repeats.expected(docs) if gone}
    docs = [(i, cut.get(i, t)) for i, t in docs]

    def leaks(text):
        words = test_decontam.words_of(text)
        return any(test_decontam.is_near(item, words) for _, item in items)

    docs = [(i, t) for i, t in docs if not leaks(t)]
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(queries.VOCABULARY), special_tokens={}
    )
    want = {}
    for i, t in docs:
        ids = library.encode_ordinary(t)
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        want[i] = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == want


def test_near_copies_from_four_fifths_on_go(spark, documents):
    import test_minhash

    from vanescope.llm import minhash

    rows, near = [], []
    for k in range(12):
        base = [f"k{k}w{j}" for j in range(100)]
        copy = list(base)
        # Each word that is changed on its own spoils five shingles of 96; four words in a row eight.
        for at in ((10, 50), (30, 70), (20, 21, 22, 23, 60), (10, 40, 70))[k % 4]:
            copy[at] = f"changed{k}"
        a, b = test_minhash.shingles(" ".join(base)), test_minhash.shingles(" ".join(copy))
        near.append(0.8 <= len(a & b) / len(a | b) < 0.85)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    assert 0 < sum(near) < 12
    docs = documents(rows)
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()}
    assert got == {i for i, _ in rows if i % 2 == 0 or not near[i // 2]}
    # op2's own limit is higher.
    assert all(r.kept for r in minhash.near_duplicates(docs).collect())


def test_texts_stay_without_a_language_to_learn(spark, awkward):
    from pyspark.sql import functions as F

    unnamed = awkward.withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.language_id(spark, unnamed, SF_DIR)
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted((i or 0, t) for i, t in AWKWARD if t and any(c.isalpha() for c in t))


def _batch_bytes(df):
    """Bytes of each batch that workers get of a table."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    return [r.n for r in df.mapInArrow(run, "n long").collect()]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_hand_small_batches_to_workers(spark, documents, tmp_path, name):
    documents([(i, "one two three " * 1000) for i in range(1000)]).coalesce(1).write.parquet(str(tmp_path / "docs"))
    whole = spark.read.parquet(str(tmp_path / "docs")).coalesce(1).select("doc_id", "text")
    setting = corpus_pipeline.BATCH_SETTING
    spark.conf.unset(setting)
    try:
        assert max(_batch_bytes(whole)) > 3 * corpus_pipeline.BATCH_BYTES
        dict(corpus_pipeline.STAGES)[name](spark, documents([(1, "one two three")]), SF_DIR)
        sizes = _batch_bytes(whole)
        assert max(sizes) <= 1.1 * corpus_pipeline.BATCH_BYTES
        assert sum(sizes) > 3 * corpus_pipeline.BATCH_BYTES
        # What the session has set itself stays.
        spark.conf.set(setting, str(1 << 20))
        dict(corpus_pipeline.STAGES)[name](spark, documents([(1, "one two three")]), SF_DIR)
        assert max(_batch_bytes(whole)) <= 1.1 * (1 << 20)
    finally:
        spark.conf.unset(setting)


def test_workers_return_memory_after_each_batch_of_packed_texts(monkeypatch):
    import pyarrow as pa

    from vanescope.llm import packed

    batch = next(packed._pack([pa.record_batch([pa.array([1, 2]), pa.array(["one", None])], names=["id", "text"])]))
    returned = []
    monkeypatch.setattr(packed, "give_back", lambda: returned.append(True), raising=False)
    assert list(packed.unpacked(batch)) == [(0, b"one"), (1, b"")]
    assert returned == [True]


def test_no_task_of_a_stage_needs_two_workers(spark, documents):
    """Python workers of a task live on, so a second one for each core would stay beside later stages."""
    import re

    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, documents([(1, "one two three"), (2, "four five six")]), SF_DIR)
        # What stands between exchanges runs in the same tasks.
        for part in re.split(r"Exchange|QueryStage", df._jdf.queryExecution().executedPlan().toString()):
            assert len(re.findall(r"(?:Map|FlatMap\w+)In(?:Arrow|Pandas)|BatchEvalPython|ArrowEvalPython", part)) <= 1, name


def test_ids_are_read_back_to_be_decoded(spark, documents):
    import hashlib

    rows = [(1, "one two three"), (1, "one two three"), (None, "h\u00e9 \U0001f600"), (2, ""), (3, None)]
    got = corpus_pipeline.tokens(spark, documents(rows), SF_DIR)
    want = [hashlib.sha256((text or "").encode()).hexdigest() for _, text in rows]
    assert sorted((r.doc_id or 0, r.decoded_sha256) for r in got.collect()) == sorted((i or 0, w) for (i, _), w in zip(rows, want))
    # Each table file that the result reads holds the ids and nothing of the texts.
    assert got.inputFiles()
    assert spark.read.parquet(*got.inputFiles()).columns == ["doc_id", "ids"]
