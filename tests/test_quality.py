from pyspark.sql import functions as F

from tessera.operators import quality as q
from tessera.operators.normalize import normalize_reviews
from tessera.plans import validation
from tessera.schemas import BRONZE_SCHEMA, INVALID_COLUMNS, SILVER_SCHEMA
from tessera.sources.history import empty_history

#: Three raw reviews with accents, a fractional and a missing rating.
BRONZE_ROWS = [
    ("https://img/a", "05/02/2024", "r-10", "2024-02-05T08:00:00Z", 0, 4.9, None, "Não abre mais", "Ana Sá"),
    ("https://img/b", "06/02/2024", "r-11", "2024-02-06T09:30:00Z", 12, 1.0, {"text": "ok"}, "travou", "João"),
    (None, "07/02/2024", "r-12", "2024-02-07T10:45:00Z", 3, None, None, "ótimo", "Zé"),
]


def raw_reviews(spark):
    df = spark.createDataFrame(BRONZE_ROWS, BRONZE_SCHEMA)
    return df.drop("response").withColumns({"app": F.lit("loja_pj"), "segmento": F.lit("pj")})


def test_normalised_reviews(spark):
    rows = normalize_reviews(raw_reviews(spark)).select("id", "rating", "title", "snippet", "likes", "segmento").collect()
    assert sorted(map(tuple, rows), key=lambda x: x[0]) == [
        ("r-10", "4", "ANA SA", "NAO ABRE MAIS", 0, "pj"), ("r-11", "1", "JOAO", "TRAVOU", 12, "pj"), ("r-12", None, "ZE", "OTIMO", 3, "pj")]


def test_a_missing_rating_fails_the_checks(spark):
    v = validation.validate(normalize_reviews(raw_reviews(spark)), empty_history(spark), "20240301")
    assert sorted(r.id for r in v.valid.collect()) == ["r-10", "r-11"] and [r.id for r in v.invalid.collect()] == ["r-12"]
    assert v.valid.columns == [f.name for f in SILVER_SCHEMA.fields]
    summary = validation.quality_summary(v.checked)
    report = {r["check"]: (r.code, r.report) for r in validation.validation_results(summary).collect()}
    assert report == {"duplicate_check": (200, "PASSOU"), "null_check": (400, "FALHOU"), "type_consistency_check": (400, "FALHOU")}
    s = summary.first()
    assert (s.batch_rows, round(s.pct_valid, 2), round(s.pct_invalid, 2), s.segments) == (3, 66.67, 33.33, ["pj"])


def test_a_row_is_quarantined_once(spark):
    """Two rows of one id, the picked one without a rating: two quarantine rows, not three."""
    batch = _batch(spark, [("a", "1", "d2", "app", "pf", None, 1, "T", "S"), ("b", "1", "d1", "app", "pf", "4", 1, "T", "S")])
    v = validation.validate(batch, empty_history(spark), "20240103")
    assert sorted((r.id, r.rating or "") for r in v.invalid.collect()) == [("1", ""), ("1", "4")]
    s = validation.quality_summary(v.checked).first()
    assert (s.invalid_count, s.batch_rows, s.pct_invalid) == (2, 2, 100.0)


def _batch(spark, rows):
    schema = ("avatar string, id string, iso_date string, app string, segmento string, rating string, "
              "likes long, title string, snippet string")
    return spark.createDataFrame(rows, schema)


def test_nulls_duplicates_and_segments(spark):
    batch = _batch(spark, [
        ("a", None, "d1", "app", "pf", "3", 1, "T", "S"),     # null id -> invalid (kept apart)
        ("a", None, "d2", "app", "pf", "3", 1, "T", "S"),     # second null id, not merged with the first
        ("a", "1", "d1", "app", "pf", "3", 1, "T", "S"),
        ("b", "1", "d2", "app", "pf", "4", 1, "T", "S"),      # duplicate id
        ("c", "2", "d1", "app", None, "4", 1, "T", "S"),      # no segment -> invalid
        ("d", "3", "d1", "app", "pj", None, 1, "T", "S"),     # null rating -> invalid
        ("e", "4", "d1", "app", "pj", "x", 1, "T", "S"),      # malformed rating, still valid
    ])
    v = validation.validate(batch, empty_history(spark), "20240103")
    valid_ids = sorted(r.id for r in v.valid.collect())
    assert valid_ids == ["1", "4"]
    inv = v.invalid.collect()
    assert sorted((r.id or "") for r in inv) == ["", "", "1", "1", "2", "3"]
    assert v.invalid.columns == INVALID_COLUMNS
    s = validation.quality_summary(v.checked).first()
    assert (s.total_records, s.duplicate_keys, s.duplicate_rows, s.null_id, s.null_rating) == (6, 1, 2, 2, 1)
    assert s.invalid_ratings == 2 and not s.type_status and not s.duplicate_status
    assert s.valid_count == 2 and s.invalid_count == 6 and s.success_count == 0 and s.error_count == 3
    assert s.type_client == "PF,PJ"


def test_duplicate_operators(spark):
    batch = _batch(spark, [("a", "1", "d", "x", "pf", "1", 1, "t", "s"), ("b", "1", "d", "x", "pf", "1", 1, "t", "s"),
                           ("c", "2", "d", "x", "pf", "1", 1, "t", "s"), ("d", None, "d", "x", "pf", "1", 1, "t", "s"),
                           ("e", None, "d", "x", "pf", "1", 1, "t", "s")])
    assert [tuple(r) for r in q.duplicate_keys(batch).collect()] == [("1", 2)]
    assert q.duplicate_rows(batch).count() == 2
    c = q.duplicate_check(batch).first()
    assert (c.status, c.code, c.n_failed) == (False, 409, 1)
    assert "1 registros" in c.message


def test_null_and_type_checks(spark):
    df = spark.createDataFrame([("1", "4.75"), ("2", "n/a"), (None, None)], "id string, rating string")
    nc = {r.column: r.n_null for r in q.null_counts(df, ["id", "rating"]).collect()}
    assert nc == {"id": 1, "rating": 1}
    t = q.type_check(df).first()
    assert (t.n_null, t.n_malformed, t.n_failed, t.code) == (1, 1, 2, 400)
    n = q.null_check(df, ["id", "rating"]).first()
    assert n.message == "Valores nulos encontrados nas colunas: {'id': 1, 'rating': 1}."


def test_history_normalise_and_regroup(spark):
    from tessera.schemas import HISTORY_ARRAY
    df = spark.createDataFrame(
        [("1", "a", "pf", "3", "d", "t", "s", None),
         ("2", "a", "pf", "3", "d", "t", "s", [("t0", "s0", "a", "pf", "2", "d0"), ("t1", "s1", "a", "pf", "1", "c0")])],
        f"id string, app string, segmento string, rating string, iso_date string, title string, snippet string, "
        f"historical_data {HISTORY_ARRAY.simpleString()}")
    n = {r.id: r.historical_data for r in q.history_empty_normalise(df).collect()}
    assert n["1"] == []
    g = {r.id: [e.iso_date for e in r.historical_data] for r in q.history_regroup(df).collect()}
    assert g == {"1": [], "2": ["c0", "d0"]}


def test_valid_invalid_neither_partition_the_checked_rows(spark):
    from tests.conftest import SF001
    from tessera.sources import fixtures as fx
    from tessera.schemas import VALID_REQUIRED
    from functools import reduce
    v = validation.validate(fx.norm(spark, SF001), fx.hist(spark, SF001), fx.RUN_DATE)
    c = v.checked
    valid = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in VALID_REQUIRED])
    bad = q.invalid_predicate(c)
    row = c.agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("v"), F.count_if(bad).alias("i"),
                F.count_if(valid & bad).alias("both"), F.count_if(~valid & ~bad).alias("neither"),
                F.count_if(~valid & ~bad & F.col("in_batch")).alias("neither_batch")).first()
    assert row.both == 0 and row.v + row.i + row.neither == row.n
    assert row.neither_batch == 0  # every batch row ends up in an output
    assert v.valid.count() == row.v
    once = c.where(bad & (F.col("n_batch") <= 1)).count()
    assert v.invalid.count() == once + v.duplicates.count()


def test_validate_ingest_results_dict(spark):
    batch = normalize_reviews(raw_reviews(spark)).where("rating is not null")
    valid, invalid, res = validation.validate_ingest(batch, empty_history(spark), "20240301")
    assert valid.count() == 2 and invalid.count() == 0
    assert res["total_records"] == 2 and res["duplicate_check"]["code"] == 200
    assert res["null_check"] == {"message": "Nenhum valor nulo encontrado nas colunas criticas.",
                                 "status": True, "code": 200}
