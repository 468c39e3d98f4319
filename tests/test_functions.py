from pyspark.sql import functions as F

from tessera.functions import (
    app_from_path,
    fold_accents,
    fold_upper,
    rating_as_int,
    segment_from_path,
    truncate_rating,
)
from tessera.functions.report import parse_kv_lines, report_lines


def test_fold_letters_and_specials(spark):
    df = spark.createDataFrame(
        [("Ação é ótima",), ("Straße",), ("Œuvre Æther Łódź",), ("plain ascii",), (None,),
         ("é",), ("“quoted” — dash…",)], "s string")
    out = [r[0] for r in df.select(fold_upper("s")).collect()]
    assert out == ["ACAO E OTIMA", "STRASSE", "OEUVRE AETHER LODZ", "PLAIN ASCII", None, "E",
                   '"QUOTED" -- DASH...']


def test_fold_keeps_case_and_ascii(spark):
    df = spark.createDataFrame([("Ñandú",)], "s string")
    assert df.select(fold_accents("s")).first()[0] == "Nandu"


def test_fold_matches_the_21_letters_of_the_data(spark):
    letters = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
    df = spark.createDataFrame([(letters,)], "s string")
    assert df.select(fold_upper("s")).first()[0] == "ACEEEINOOUSSACEEEINOOU"


def test_rating_truncation(spark):
    df = spark.createDataFrame([(4.9,), (2.0,), (1.75,), (None,), (float("nan"),)], "r double")
    assert [r[0] for r in df.select(truncate_rating("r")).collect()] == ["4", "2", "1", None, None]


def test_rating_as_int_from_text(spark):
    df = spark.createDataFrame([("4.75",), ("3",), ("n/a",), ("",), (None,)], "r string")
    assert [r[0] for r in df.select(rating_as_int("r")).collect()] == [4, 3, None, None, None]


def test_path_lineage(spark):
    df = spark.createDataFrame([
        ("/googlePlay/test_pf/odate=20240101",),
        ("hdfs://nn/bronze/googlePlay/banco_pj/odate=20240101/part-0.parquet",),
        ("/x/googlePlay/my_app_pf/odate=20240101/p",),
        ("/x/googlePlay/app_pf/dt=1",),
    ], "p string")
    rows = df.select(app_from_path(F.col("p")), segment_from_path(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [("test_pf", "pf"), ("banco_pj", "pj"), ("my_app_pf", ""), ("", "")]


def test_kv_report_parse(spark):
    report = "a => 1\nb = 2 ms (3 s)\nScheduling mode = FIFO\nx = 1 = 2\n\n a => 5 "
    df = spark.createDataFrame([(1, report)], "rid int, report string")
    out = {(r.key, r.value) for r in parse_kv_lines(report_lines(df, "report", ["rid"]), ["rid"]).collect()}
    # later line wins for a repeated key
    assert out == {("a", "5"), ("b", "2 ms (3 s)")}


def test_fold_no_break_space_and_combining_marks(spark):
    df = spark.createDataFrame([("a\u00a0b",), ("e\u0301te\u0301",), ("été",)], "s string")
    assert [r[0] for r in df.select(fold_upper("s")).collect()] == ["A B", "ETE", "ETE"]
