"""The samples that models are learnt from are bounded, whatever the labels look like."""

import pytest
from pyspark.sql import functions as F

from tickloom.llm.language import learn_languages
from tickloom.llm.learning import LONGEST, MOST_LABELS, bounded


@pytest.mark.parametrize("labels, rows", [(3, 30_000), (500, 200_000), (3000, 60_000)])
def test_bounded_in_all(spark, labels, rows):
    table = spark.range(rows).select(
        F.col("id").alias("key"),
        F.concat(F.lit("l"), F.col("id") % labels).alias("label"),
        F.concat(F.lit("text "), F.floor(F.col("id") / 2).cast("string")).alias("text"),
    )
    chosen = bounded(table, "label", "key", "text", 4000)
    count = chosen.groupBy("label").count()
    total, least, found = count.agg(F.sum("count"), F.min("count"), F.count("*")).first()
    # shares are drawn by hash, so a rare label may be missed when each has a few texts only
    assert 3000 < total < 5200 and found > 0.9 * min(labels, MOST_LABELS)
    if labels == 3:
        assert least > 1100


def test_copies_take_one_place(spark):
    table = spark.range(40_000).select(
        F.col("id").alias("key"),
        F.lit("x").alias("label"),
        F.when(F.col("id") < 30_000, "copied").otherwise(F.col("id").cast("string")).alias("text"),
    )
    chosen = bounded(table, "label", "key", "text", 2000)
    assert chosen.where("text = 'copied'").count() <= 1 and 1700 < chosen.count() < 2300
    small = bounded(table.where("id >= 29999"), "label", "key", "text", 20_000)
    assert small.count() == 10_001
    assert bounded(table.where("false"), "label", "key", "text", 5).count() == 0


def test_very_long_texts_are_not_learnt_from(spark):
    docs = spark.createDataFrame(
        [(i, "y" * (LONGEST + 1) if i % 2 else f"word {i}", "a" if i % 2 else "b") for i in range(12)],
        "doc_id long, text string, lang string",
    )
    assert learn_languages(docs) is not None
    assert learn_languages(docs.where("lang = 'a'")) is None
