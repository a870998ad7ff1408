"""From documents to token ids: five stages, each of which reads what the one before has written.

1. language ID: documents whose language cannot be told, having no text or no letter, go. Others stay
   also where there is no language to learn from.
2. near-duplicates: of each component of near-duplicates one document stays, that with the smallest id.
3. substring de-duplication: words that repeat a passage of an earlier document go. A document that
   loses words keeps the others, joined by one blank; every other text stays as it is.
4. benchmark decontamination: documents that hold a benchmark item, exactly or edited, go.
5. byte-level BPE: the token ids of what is left, and their round trip, as digests.

Stages 1 to 4 return the columns of their input, also those they don't know; where there is a column
``n_chars`` it follows the text. Rows with a NULL id pass stages that decide by id: they cannot be
told apart from others. Rows that repeat an id share its fate.

Every stage hands texts to Python workers. So that an executor's memory doesn't hold a whole
partition several times over, the stages set the size of a batch of rows on its way to a worker, in
the session, unless that has set one itself. No task needs two workers at a time: workers live on
after their tasks, and a second one for each core would stay beside all later stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanescope.llm import bpe, decontam, language, minhash, queries, repeats
from vanescope.llm.stored import stored


#: Of the shingles of two near-duplicates together, at least so many are common to both.
NEAR_PERCENT = 80
#: Spark's setting for the size of a batch, and about how many bytes a batch has in the stages.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def _small_batches(spark: SparkSession) -> None:
    """Results don't depend on it; Spark takes the setting when a query runs, so it stays."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is not in column ``__gone`` of ``ids``."""
    return docs.join(ids, F.col("doc_id") == F.col("__gone"), "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    model = language.train(docs)
    if not model.langs:
        # Nothing to learn from: what has a letter has a language, though it cannot be named.
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # The verdict depends on the text alone and travels with it, so nothing is joined.
    return language.with_language(docs, model, "__lang").where(F.col("__lang") != language.UNDETERMINED).drop("__lang")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    found = minhash.near_duplicates(docs, percent=NEAR_PERCENT).where("doc_id IS NOT NULL AND NOT kept")
    return _without(docs, found.select(F.col("doc_id").alias("__gone")).distinct())


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return repeats.cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    leaks = decontam.find_leaks(docs, queries.table(spark, sf_dir, "benchmark"))
    gone = stored(leaks.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("__gone")).distinct(), "leaks")
    return _without(docs, gone)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    # Ids are decoded from a table, by the workers that have encoded them. In one pass either step
    # would take a worker of its own for each task.
    return queries.token_digests(stored(bpe.encode(docs, queries.VOCABULARY), "ids"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
