"""The corpus pipeline: documents become packed training windows in five stages.

STAGES names the stages in their order. Each is a function of the session, the documents that the
stage before it kept, and the folder of the tables; each works on all of them. All but the last
return the columns of documents. Stages 1 and 2 take learnt or native decisions row by row; stages
2 to 4 write what they must agree on to the shared folder.

All stages take documents as they come. A null text counts as empty and stays null; empty texts have
no words, share one fingerprint and fill a piece of one token. Texts are worked on whole, however
long. Rows without an id are told apart by their texts; rows that repeat an id count as one document
for lines, and as documents of their own, told apart by their texts, for near duplicates; of equal
rows one stays. Ties go to the smaller id. Columns of any other name are carried along by all stages
but the last. An empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, lines, packing, quality, simhash
from tickloom.llm.common import stage, table

TOKENIZER = "byte_bpe_50k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    model = quality.learn_quality(docs, table(spark, sf_dir, "labels"))
    return quality.good_documents(docs, model)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines whose template another document had first; every document stays."""
    changed = lines.without_recurring_lines(docs)
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training windows; one row per piece of a document."""
    return packing.digest(packing.pack(docs, public_tokenizers.path(TOKENIZER), added_tokens=True))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_recurring_lines),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_windows),
]

# A trained field, fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents; between them the documents are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
