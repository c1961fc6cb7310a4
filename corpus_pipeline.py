"""A corpus pipeline of the training-data operators: what is kept of documents, stage by stage, down to packed sequences.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents, whatever further columns ``docs`` has; each reads
whole texts of any length; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasheaf.llm import decontam, packing, pii, queries, repetition, simhash
from terrasheaf.llm.common import materialize
from terrasheaf.runtime import ship

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null or empty text fails them; ids play no part; repeated rows are judged alike."""
    ship(spark)
    return repetition.verdict(repetition.text_measures(docs, COLUMNS)).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: the smallest id, a null id last, then the smallest hash of the row.

    Rows are told apart by all their columns: different texts with equal or null ids stay unless they are near-duplicates. Null and wordless
    texts are one group; of rows alike in all columns one stays."""
    ship(spark)
    return simhash.representatives(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs. Null text has no words and stays; ids play no part; repeated rows are judged
    alike; items with a null id or text are left out."""
    ship(spark)
    items = queries.table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return decontam.contamination(docs.select(*COLUMNS), items, COLUMNS).where(~F.col("contaminated")).select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars counted anew where something was replaced. Null or empty text stays
    what it is; repeated rows are redacted alike."""
    ship(spark)
    found = pii.find_personal_data(docs, [c for c in COLUMNS if c != "text"], redacted=True)
    text = F.col("__redacted")
    return found.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.char_length(text).cast("long")).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences, with their token ids. Null or empty text is its end id alone; a text longer than a sequence is cut;
    repeated rows are packed once each; a null id stays."""
    ship(spark)
    return packing.pack(docs, queries.tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("decontamination", decontaminate), ("personal data", redact), ("packing", pack)]
#: SQL can't express the suffix array, the fingerprints or the tokens; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, with each stage's result written to the shared folder and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k + 1}")
    return docs
