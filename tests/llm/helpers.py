"""Tables that every operator must handle, and the test data as pandas frames."""

import duckdb

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
#: Columns whose names an operator might use itself.
CLASHES = ["id", "text_hash", "fp", "row", "k", "r", "size", "u", "score", "n", "y", "words", "copies", "key", "none", "th", "pseudonymised"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(sf_dir, sql):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.sql(sql).df()


def odd_rows():
    long = " ".join(f"w{i % 997} x{i % 89}" for i in range(30_000))
    copy = "One passage that stands here more than once, and is long enough. " * 12
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n\x0b ", None, None, 4), (None, "a text without an id", "en", "b", 20),
        (None, None, None, None, None), (5, long, "en", "b", len(long)), (6, copy, "en", None, len(copy)), (7, copy, "en", "a", len(copy)),
        (7, copy, "en", "a", len(copy)), (8, "one", "fr", "c", 3), (8, "two  words ", "fr", "c", 11), (9, "été <|endoftext|> 你好 \U0001f600\n\n end", "zh", "c", 20),
        (10, "12 34 !!! ...", "xx", "c", 13),
    ]


def odd_documents(spark, clashes=True):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"other {c}") for c in CLASHES})
    return df


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
