"""The corpus pipeline: language identification, near-duplicate removal,
benchmark decontamination, masking of personal data, tokenisation.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all rows its
predecessor kept; all but the last return the columns they were given.  ``run``
writes each stage's result as Parquet below ``spark.checkpoint.dir`` and reads
it back for the next one.

Decisions: documents without a recognisable language go; of each near-duplicate
group the row with the smallest doc_id stays (rows without an id only where the
group has no other); contaminated documents go; personal data is masked in the
text; the last stage returns token ids.

Defined results: a null or empty text, and one without a letter, has no language and
goes with the first stage; null labels are not learned; a document without an id is
kept or dropped as any other; of rows that are equal in id and text one is left; an
empty table, a table without labels or an empty benchmark gives an empty result or
drops nothing; columns of any other name travel through every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawhouse.llm import langid, pii, queries, simhash_vp, spm, winnow
from rawhouse.llm.common import free_name
from rawhouse.session import discard, materialize

# No SQL expresses the learned language model, XXH64 or byte-pair merging; the
# stages are tested against brute force in tests/llm.
ORACLE_SQL: str | None = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised (op 9)."""
    model = langid.train_language_model(docs.where(queries.remainder("doc_id", 5) != 0))
    lang, score = free_name(docs, "lang_found"), free_name(docs, "lang_score")
    scored = langid.identify_language(docs, model, keep=docs.columns, lang_out=lang, score_out=score)
    return scored.where(F.col(lang) != langid.UND).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group (op 5)."""
    return simhash_vp.keep_first(docs, "doc_id", "text", max_bits=2, shingle=3, seed=42)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents without a passage of a benchmark item (op 3)."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return winnow.drop_contaminated(docs, items)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data in the texts (op 2)."""
    return pii.mask_private(docs, pii.train(docs))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left (op 6)."""
    vocabulary = spm.load_vocabulary(queries.default_model())
    found = spm.encode(docs, vocabulary, keep=["doc_id"])
    return found.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        done = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(docs)  # nothing reads the stage before any more
        docs = done
    return docs
