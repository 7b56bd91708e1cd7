"""The registered queries of the subpackage: one per operator, and the SQL of those that have it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spokewise.llm import (
    chat,
    decontaminate,
    lines,
    oracle,
    packing,
    phrases,
    private,
    search,
    secrets,
    simhash,
    suffixes,
    toxicity,
    trie,
    vectors,
)
from spokewise.llm.common import table
from spokewise.session import stored


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"]
    )
    return found.select("doc_id", "contamination.*").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        F.expr("n_hit > 0 AND 20 * n_hit >= n_words").alias("contaminated"),
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = stored(simhash.fingerprints(table(spark, sf_dir, "documents"), ["doc_id"]), "fingerprints")
    return simhash.components(marked).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model, ["doc_id"])
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxicity.passages").cast("long").alias("n_passages"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedupe_lines(table(spark, sf_dir, "documents"), ["doc_id"])
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    known = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], conversations.schema)
    return chat.read_back(stored(chat.examples(chat.pieces(conversations.union(known))), "chat-examples"))


def op8_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = phrases.drop_repeated_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private.detect(table(spark, sf_dir, "documents"))
    counts = [
        F.size(private.of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in private.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(private.written(F.col("base")), 256).alias("base_sha256"),
        private.written(private.in_kind_order(F.col("base"), F.col("added"))).alias("spans"),
        (F.size("base") + F.size("added")).cast("long").alias("n_spans"),
    )


def op10_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.drop_repeated_bytes(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secrets.scan(documents, secrets.fit(documents), ["doc_id"])

    def written(spans: str) -> str:
        return f"array_join(transform(secrets.{spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    counts = [
        F.expr(f"CAST(size(filter(secrets.base, s -> s.kind = '{k}')) AS LONG)").alias(f"n_{k}") for k in secrets.PATTERNS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(written("base")), 256).alias("base_sha256"),
        F.expr(written("spans")).alias("spans"),
        F.size("secrets.spans").cast("long").alias("n_spans"),
    )


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination,
    op2_simhash_near_dedup,
    op3_toxicity,
    op4_packing,
    op5_embedding_near_dedup,
    op6_line_dedup,
    op7_chat_prefix_targets,
    op8_phrase_automata,
    op9_private_data,
    op10_suffix_radix,
    op11_conversation_trie,
    op12_lexical_search,
    op13_secret_scan,
)}
ORACLE: dict[str, str] = {"op11_conversation_trie": oracle.TRIE, "op12_lexical_search": oracle.SEARCH}
