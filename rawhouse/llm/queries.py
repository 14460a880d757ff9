"""The registered queries of the corpus operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawhouse.llm import html_main, langid, licenses, pii, prefix_trie, secrets_index, sharding, simhash_vp, spm, toxicity, vectors, whitening, winnow


def default_model() -> str:
    """Path of the SentencePiece model the queries use (a parameter of the operator)."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text modulo ``by`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by


def _n_of_kind(spans: str, kind: str) -> Column:
    """Number of the spans ``kind:start:end`` that are of ``kind``.  (The function given
    to ``F.filter`` has one parameter: Spark fills a second one with the index.)"""
    return F.size(F.filter(spans, lambda s: s.startswith(f"{kind}:"))).cast("long")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"), keep=["doc_id"]).drop("places")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document, counted and digested."""
    docs = _table(spark, sf_dir, "documents")
    found = pii.find_private(docs, pii.train(docs), keep=["doc_id"])
    return found.select(
        "doc_id",
        *[_n_of_kind("base_spans", kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(F.concat_ws(",", "base_spans"), 256).alias("base_sha256"),
        F.concat_ws(",", "spans").alias("spans"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    found = winnow.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_main.extract_main_text(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 2 bits)."""
    found = simhash_vp.near_duplicates(_table(spark, sf_dir, "documents"), max_bits=2, shingle=3, seed=42)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and whether they decode to its text."""
    vocabulary = spm.load_vocabulary(default_model())
    found = spm.encode(_table(spark, sf_dir, "documents"), vocabulary, keep=["doc_id"])
    return found.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding at cosine 0.95 or above."""
    found = vectors.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.95)
    return found.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of toxicity of every document; learned from the labels not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(remainder("doc_id", 3) != 1))
    scored = docs.select("doc_id", "text", (remainder("doc_id", 3) == 1).alias("held_out"))
    found = toxicity.score_toxicity(scored, model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "passages")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from the rows not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train_language_model(docs.where(remainder("doc_id", 5) != 0))
    scored = docs.select("doc_id", "text", (remainder("doc_id", 5) == 0).alias("held_out"))
    return langid.identify_language(scored, model, keep=["doc_id", "held_out"])


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 40 shards whose row counts differ by one at most."""
    placed = sharding.shuffled(_table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    rebuilt = prefix_trie.grafted(prefix_trie.conversations(_table(spark, sf_dir, "conversations")), every=5, most=9)
    return prefix_trie.prefix_trie(rebuilt).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding projected on the 32 leading components, whitened."""
    found, model = whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32)
    shares, error = [0.0], 0.0
    if model is not None and len(model.values):
        shares = (model.values / model.trace).tolist()
        error = whitening.identity_error(found, len(shares), model.n)
    each = found.select("id", "n", "deviation", F.posexplode("whitened").alias("at", "value"))
    return each.select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(F.array(*map(F.lit, shares)), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, counted and digested."""
    found = secrets_index.find_secrets(_table(spark, sf_dir, "documents"), keep=["doc_id"])

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: F.substring_index(s, ":", 1).isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in secrets_index.BASE_KINDS),
        F.sha2(F.concat_ws(",", of(*secrets_index.BASE_KINDS)), 256).alias("base_sha256"),
        F.concat_ws(",", "spans").alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_personal_data": op2_personal_data,
    "op3_decontamination": op3_decontamination,
    "op4_html_extraction": op4_html_extraction,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_language_id": op9_language_id,
    "op10_sharding": op10_sharding,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_secret_scans": op13_secret_scans,
}
