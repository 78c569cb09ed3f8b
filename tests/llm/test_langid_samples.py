"""Every labelled language has samples, whatever the copies and lengths of its texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from daylake.llm import langid

SCHEMA = "doc_id long, text string, lang string"


def test_a_language_of_copies_has_all_its_texts(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("texto repetido com letra "), F.element_at(F.array(*map(F.lit, "abcde")), (F.col("id") % 5 + 1).cast("int"))).alias("text"),
        F.lit("pt").alias("lang"),
    )
    other = spark.createDataFrame([(n, f"ein wort {n}", "de") for n in range(99)], SCHEMA)
    picked = langid.sample(rows.unionByName(other), per_language=50)
    assert len({text for text, lang in picked if lang == "pt"}) == 5
    assert langid.fit_model(picked).languages == ["de", "pt"]


def test_long_texts_are_used_where_there_are_no_short_ones(spark):
    rows = [(n, "palavra " * (40 + n), "pt") for n in range(30)] + [(n, "ein wort", "de") for n in range(9)]
    rows += [(n, f"{n}", "pt") for n in range(30)] + [(n, "das wort " * 99, "de") for n in range(9)]
    picked = langid.sample(spark.createDataFrame(rows, SCHEMA), per_language=5, chars=200)
    assert {lang for _, lang in picked} == {"de", "pt"}
    lengths = [len(text) for text, lang in picked if lang == "pt"]
    assert lengths == sorted(lengths) and sum(lengths[:-1]) < 5 * 200
    assert [text for text, lang in picked if lang == "de"] == ["ein wort"]
