"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vanescope.llm import alignment, bpe, centroids, chat, decontam, language, licenses, minhash, quality, repeats, topk, toxicity, warc
from vanescope.llm.ship import ship

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CHAT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

#: A conversation that says control strings, added to those of the table.
TEST_CONVERSATION = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, rest: int) -> Column:
    """Whether a document is kept from training."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus == rest


def token_digests(encoded: DataFrame) -> DataFrame:
    """Number of ids, digest of the ids and digest of what they decode to."""
    return bpe.decode(encoded, VOCABULARY).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to, as digests."""
    return token_digests(bpe.encode(table(spark, sf_dir, "documents"), VOCABULARY))


def op2_min_max_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from four fifths of the labels."""
    labels = table(spark, sf_dir, "labels").where(~held_out(5, 0))
    found = quality.classify(table(spark, sf_dir, "documents"), labels)
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0)


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, how many repeat an earlier one, and a digest of the rest."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    documents = table(spark, sf_dir, "documents")
    model = language.train(documents.where(~held_out(4, 2)))
    found = language.identify(documents, model)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to web archives and read back from them."""
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and detections in every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    starts, base = F.col("base.first_word"), F.col("base.label")
    weight = F.coalesce(F.array_max("found.weight"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, "found.label")), ",").alias("labels"),
        F.when(F.size("base") > 0, F.greatest(weight, F.lit(0.9))).otherwise(weight).alias("score"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from two thirds of the labels."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels").where(~held_out(3, 1)))
    found = toxicity.score(documents, model)
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents, exact or edited: one row per document and item."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector after ten rounds over eight centroids."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of the tokens of two tokenizers in every document, and how common they are."""
    return alignment.align(table(spark, sf_dir, "documents"), CHAT_VOCABULARY, PIECES)


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and masked, then read back, as digests."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(TEST_CONVERSATION, "conv_id long, turn long, role string, text string"))
    found = chat.read_back(chat.format_conversations(rows, CHAT_VOCABULARY))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_min_max_hash": op2_min_max_hash,
    "op3_quality": op3_quality,
    "op4_top_k": op4_top_k,
    "op5_repeats": op5_repeats,
    "op6_language": op6_language,
    "op7_warc": op7_warc,
    "op8_licenses": op8_licenses,
    "op9_toxicity": op9_toxicity,
    "op10_leaks": op10_leaks,
    "op11_centroids": op11_centroids,
    "op12_alignment": op12_alignment,
    "op13_chat": op13_chat,
}


def _centroids_sql(rounds: int = 10) -> str:
    """The rounds written out one after the other, every distance computed anew."""
    steps = ["""
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""", """
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
            FROM (SELECT sha256('3:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h LIMIT 8)
        )"""]
    for n in range(rounds + 1):
        steps.append(f"""
        a{n} AS MATERIALIZED (
            SELECT r, vec_id, v, best.c AS c, best.d AS d FROM (
                SELECT r, any_value(vec_id) AS vec_id, any_value(k.v) AS v, min({{'d': d, 'c': c}}) AS best FROM (
                    SELECT r, vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, c{n}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
                    FROM kept CROSS JOIN c{n}
                ) k GROUP BY r
            )
        )""")
        if n < rounds:
            steps.append(f"""
        c{n + 1} AS MATERIALIZED (
            SELECT c{n}.c AS c, coalesce(moved.v, c{n}.v) AS v FROM c{n} LEFT JOIN (
                SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v
                FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{n} CROSS JOIN range(1, 65) AS t(i) GROUP BY c, i)
                GROUP BY c
            ) moved ON moved.c = c{n}.c
        )""")
    return "WITH " + ",".join(steps) + f"""
        SELECT vec_id, CAST(a{rounds}.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON a{rounds}.c = c{rounds}.c
    """


def _chat_sql() -> str:
    marks = sum(map(len, chat.MARKS)) + 1
    added = " UNION ALL ".join(f"SELECT {conv}, {turn}, '{role}', '{text}'" for conv, turn, role, text in TEST_CONVERSATION)
    escaped = f"length(regexp_replace({{}}, '{chat.CONTROL_PATTERN}', '\\1\\\\\\2\\3', 'g'))"
    order = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
    return f"""
        WITH rows AS (
            SELECT conv_id, turn, role, text FROM conversations UNION ALL {added}
        ), filled AS (
            SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS t FROM rows
        )
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' {order})) AS turns_sha256,
               CAST(sum(CASE WHEN r = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN r = 'assistant' THEN t ELSE '' END, '' {order})) AS loss_sha256,
               CAST(sum({marks} + {escaped.format("r")} + {escaped.format("t")}) AS BIGINT) AS formatted_chars
        FROM filled GROUP BY conv_id
    """


SQL: dict[str, str] = {
    "op4_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op7_warc": """
        WITH facts AS (
            SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), first AS (
            SELECT payload_digest, min(page_id) AS response FROM facts WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN response <> page_id THEN response END AS refers_to
        FROM facts LEFT JOIN first USING (payload_digest)
    """,
    "op11_centroids": _centroids_sql(),
    "op13_chat": _chat_sql(),
}
