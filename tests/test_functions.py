"""Text, amount, code and similarity functions on tables of cases."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from patrimonia.functions import amounts, codes, similarity, text

AMOUNTS = [
    ("35 807,98€", 35807.98), ("1747.05 €", 1747.05), ("45.000", 45000.0), ("1.000.000", 1000000.0), ("-3787,09", -3787.09), ("3600 €", 3600.0), ("30057,72", 30057.72), ("2 344,91€", 2344.91),
    ("83.503,34 7", 83503.34), ("45798'50", 45798.5), ("70,972,93", 70972.93), ("13681.81", 13681.81), ("8.552 €", 8552.0), ("1,4", 1.4), ("4:622,51", 4622.51), ("", None), ("sin datos", None),
    (None, None), ("1.0000", 10000.0), ("1,2.3,4", None), ("14,647", 14647.0), ("9,451,09", 9451.09), ("O,5O", 0.5), ("- 12 EUR", -12.0), ("1'234'567", 1234567.0), ("€", None),
]


def test_amounts(spark):
    df = spark.createDataFrame(AMOUNTS, "t string, want double")
    assert df.withColumn("got", amounts.parse_amount("t")).where("not (got <=> want)").collect() == []


def test_shares(spark):
    cases = [("50%", 50.0), ("1/2", 50.0), ("33,33 %", 33.33), ("P", None), ("3/2", 150.0), ("1/0", 1.0), ("101", None), (None, None), ("1 / 3", 33.33)]
    df = spark.createDataFrame(cases, "t string, want double")
    assert df.withColumn("got", amounts.parse_share("t")).where("not (got <=> want)").collect() == []


def test_similarity_is_asymmetric_and_exact(spark):
    rng = random.Random(0)
    pairs = [("".join(rng.choice("ABCÑ é") for _ in range(rng.randrange(9))), "".join(rng.choice("ABCÑ é") for _ in range(rng.randrange(9)))) for _ in range(300)]
    got = spark.createDataFrame(pairs, "a string, b string").select(similarity.similarity("a", "b").alias("r"), text.compact_norm("a").alias("a"), text.compact_norm("b").alias("b")).collect()
    assert all(r.r == (SequenceMatcher(None, r.a, r.b).ratio() if r.a and r.b else 0.0) for r in got)


def test_codes_with_other_readings_and_swapped_cells(spark):
    df = spark.createDataFrame([("??", ["", "Pleno"], "V", []), ("Vivienda", [], "P", []), ("V", [], "V", []), (None, None, "local", None)], "a string, aa array<string>, b string, ba array<string>")
    got = df.select(codes.code_pair(F.col("a"), F.col("b"), F.col("aa"), F.col("ba"), F.lit(False)).alias("c")).collect()
    assert [tuple(r.c) for r in got] == [("P", "V"), ("P", "V"), (None, "V"), (None, "L")]


@pytest.mark.parametrize("function", [text.norm_text, text.fold_text, text.title_case_name, text.has_word, codes.classify_asset, codes.classify_liability])
def test_null_and_empty(spark, function):
    got = spark.createDataFrame([(None,), ("",), ("x" * 100_000,)], "t string").select(function("t").alias("r")).collect()
    assert len(got) == 3 and got[0].r == got[1].r
