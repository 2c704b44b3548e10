"""What the classifiers learn from: bounded rows, all languages, held-out accuracy."""

import pytest
from pyspark.sql import functions as F

from letramento.llm import labelled, language, quality, toxicity
from letramento.llm.common import read_table

SF = "/root/testdata/sf0.01"


def test_one_identifier_on_a_third_of_the_rows_counts_once(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
                                      F.concat(F.lit("text "), F.col("id") % 1000).alias("text"))
    labels = rows.select("doc_id", F.lit(1).alias("toxic"))
    got = labelled.fit_sample(rows.repartition(8), labels, "toxic", 3, 1, most=500)
    assert got.count() == 500 == got.select("id").distinct().count()
    every = labelled.fit_sample(rows, labels, "toxic", 3, 1, most=100_000)
    assert every.where("id = 0").count() == 1
    assert every.count() == rows.where(~labelled.held_out("doc_id", 3, 1)).select("doc_id").distinct().count()


def test_languages_learn_bounded_rows_and_every_language(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_TEXTS", 40)
    monkeypatch.setattr(language, "LANDMARKS", 12)
    docs = read_table(spark, SF, "documents").select("doc_id", "text", "lang")
    rare = spark.createDataFrame([(10**9 + i, "\u03b1\u03b2\u03b3 \u03b4\u03b5\u03b6 \u03b7\u03b8", "el") for i in range(6)], docs.schema)
    hot = spark.range(1500).select(F.lit(-1).cast("long").alias("doc_id"), F.lit("the and of to in").alias("text"), F.lit("en").alias("lang"))
    model = language.fit_languages(docs.unionByName(rare).unionByName(hot))
    assert "el" in model.languages and len(model.languages) == docs.select("lang").distinct().count() + 1
    assert model.predict(["\u03b1\u03b2\u03b3 \u03b7\u03b8"])[0] == ["el"]


def test_numerals_are_no_letters():
    assert not any(language.has_letter(t) for t in ("\u00bd \u00b2 12", "", None, "_-!", "\u2460"))
    assert language.has_letter("\u00bd a") and language.has_letter("\u00b2\u4e16")


@pytest.mark.parametrize("kind", ["toxic", "quality"])
def test_held_out_rows_are_told_apart(spark, kind):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    run = toxicity.score_toxicity if kind == "toxic" else quality.classify_quality
    got = run(docs, labels).join(labels, "doc_id").where("held_out")
    assert got.count() > 50 and got.where(F.col("predicted") == F.col(kind)).count() >= 0.9 * got.count()
