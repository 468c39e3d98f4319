from pyspark.sql import functions as F

from tessera.operators import snapshot
from tessera.plans import validation

NEW_SCHEMA = ("avatar string, id string, iso_date string, app string, segmento string, "
              "rating string, likes long, title string, snippet string")
HIST_SCHEMA = ("id string, app string, segmento string, rating string, iso_date string, "
               "title string, snippet string, odate string")


def new_df(spark, rows):
    return spark.createDataFrame(rows, NEW_SCHEMA)


def hist_df(spark, rows):
    return spark.createDataFrame(rows, HIST_SCHEMA)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_change_history_and_fallback(spark):
    new = new_df(spark, [
        ("av1", "1", "2024-02-02T00:00:00Z", "app", "pf", "5", 1, "T", "S"),     # title changed
        ("av2", "2", "2024-02-02T00:00:00Z", "app", "pj", "4", 2, None, "S2"),   # null title -> old
        ("av3", "3", "2024-02-03T00:00:00Z", "app", "pf", "3", 3, "T3", "S3"),   # new only
    ])
    hist = hist_df(spark, [
        ("1", "app", "pf", "5", "2024-02-02T00:00:00Z", "OLD T", "S", "20240101"),
        ("1", "app", "pf", "5", "2024-02-02T00:00:00Z", "OLD T", "S", "20240102"),  # same version twice
        ("1", "app", "pf", "5", "2024-02-02T00:00:00Z", "T", "S", "20240102"),      # unchanged version
        ("2", "app", "pj", "4", "2024-02-02T00:00:00Z", "OLDT2", "S2", "20240101"),
        ("4", "app", "pj", "2", "2024-02-01T00:00:00Z", "T4", "S4", "20240101"),    # history only
        ("1", "app", "pf", "1", "2024-01-01T00:00:00Z", "FUT", "S", "20240105"),    # after run date
    ])
    m = by_id(snapshot.snapshot_merge(new, hist, "20240103"))
    assert set(m) == {"1", "2", "3", "4"}
    h1 = m["1"]["historical_data"]
    assert [(e.title, e.segmento) for e in h1] == [("OLD T", "pf")]  # de-duplicated, unchanged dropped
    assert m["2"]["title"] == "OLDT2"            # coalesce(new, old)
    assert len(m["2"]["historical_data"]) == 0   # null new title never counts as a change
    assert m["3"]["historical_data"] == [] and m["3"]["in_batch"]
    assert m["4"]["segmento"] is None and not m["4"]["in_batch"] and m["4"]["likes"] is None
    assert m["4"]["historical_data"] == []


def test_duplicates_pick_is_deterministic(spark):
    rows = [("a", "1", "2024-02-01T00:00:00Z", "app", "pf", "3", 1, "T", "S"),
            ("b", "1", "2024-02-01T12:00:00Z", "app", "pf", "4", 2, "T", "S"),
            ("c", "1", None, "app", "pf", "5", 3, "T", "S")]
    empty = hist_df(spark, [])
    for order in (rows, rows[::-1]):
        m = by_id(snapshot.snapshot_merge(new_df(spark, order).repartition(3), empty))
        assert m["1"]["avatar"] == "b" and m["1"]["n_batch"] == 3


def test_left_and_full_outer_give_same_outputs(spark):
    from tests.conftest import SF001
    from tessera.sources import fixtures as fx
    norm, hist = fx.norm(spark, SF001), fx.hist(spark, SF001)
    full = validation.validate(norm, hist, fx.RUN_DATE, how="full_outer")
    left = validation.validate(norm, hist, fx.RUN_DATE, how="left_outer")
    cols = ["id", "app", "segmento", "rating", "iso_date", "title", "snippet"]
    assert sorted(full.valid.select(*cols).collect()) == sorted(left.valid.select(*cols).collect())
    assert sorted(map(tuple, full.invalid.collect()), key=str) == sorted(map(tuple, left.invalid.collect()), key=str)


def test_salted_join_equals_unsalted(spark):
    from tessera.registry import _one_hot
    from tests.conftest import SF001
    from tessera.sources import fixtures as fx
    norm = fx.norm(spark, SF001)
    for hist in (fx.hist(spark, SF001), _one_hot(spark, SF001)):
        plain = snapshot.history_join(norm, hist, "left_outer", fx.RUN_DATE)
        for rows_per_task in (1, 5, 1000):
            salted = snapshot.salted_history_join(norm, hist, rows_per_task, fx.RUN_DATE).select(*plain.columns)
            assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_sketch_names_the_hot_id_alone(spark):
    rows = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS id").repartition(5)
    found = {r.id: r.salts for r in snapshot.heavy_hitters(rows.unionByName(spark.range(9).selectExpr("cast(null AS string) AS id")), "id", 1000).collect()}
    assert set(found) == {"hot"} and 20 <= found["hot"] <= 21
    assert snapshot.heavy_hitters(rows.limit(0), "id", 1000).count() == 0


def test_hot_key_is_not_collapsed_into_one_group(spark):
    """A key holding a large share of the batch still yields one merged row and
    the right duplicate count (partial aggregation does the work)."""
    hot = [("av", "hot", f"2024-02-01T00:00:{i % 60:02d}Z", "app", "pf", "4", i, "T", "S") for i in range(3000)]
    cold = [("av", str(i), "2024-02-01T00:00:00Z", "app", "pj", "3", i, "T", "S") for i in range(3000)]
    new = new_df(spark, hot + cold).repartition(8)
    m = snapshot.snapshot_merge(new, hist_df(spark, []))
    row = m.where("id = 'hot'").first()
    assert row["n_batch"] == 3000 and row["iso_date"] == "2024-02-01T00:00:59Z"
    assert m.count() == 3001


def test_plan_has_no_python_and_one_shuffle_per_side(spark):
    from tests.conftest import SF001
    from tessera.sources import fixtures as fx
    m = snapshot.snapshot_merge(fx.norm(spark, SF001), fx.hist(spark, SF001), fx.RUN_DATE)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # one hash exchange per side; the join reuses both partitionings
    assert plan.count("Exchange hashpartitioning") == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_history_key_many_days(spark):
    """One id holds most of the history (the same version re-written every
    day plus a few real changes): the merge keeps one row per distinct version."""
    days = [f"2023{m:02d}{d:02d}" for m in range(1, 13) for d in range(1, 29)]
    rows = [("hot", "app", "pf", "4", "2024-01-01T00:00:00Z", "T", "S", d) for d in days]
    rows += [("hot", "app", "pf", "3", "2024-01-01T00:00:00Z", "T", "S", "20231229"),
             ("hot", "app", "pf", "4", "2024-01-01T00:00:00Z", "T0", "S", "20231230")]
    rows += [(str(i), "app", "pj", "2", "2024-01-01T00:00:00Z", "T", "S", "20231201") for i in range(300)]
    hist = hist_df(spark, rows).repartition(8)
    new = new_df(spark, [("a", "hot", "2024-01-01T00:00:00Z", "app", "pf", "4", 1, "T", "S")])
    m = by_id(snapshot.snapshot_merge(new, hist, "20240101"))
    h = m["hot"]["historical_data"]
    assert sorted((e.rating, e.title) for e in h) == [("3", "T"), ("4", "T0")]
    assert len(m) == 301


def test_result_independent_of_partitioning(spark):
    from tests.conftest import SF001
    from tessera.registry import flatten_history
    from tessera.sources import fixtures as fx
    norm, hist = fx.norm(spark, SF001), fx.hist(spark, SF001)
    base = flatten_history(snapshot.snapshot_merge(norm, hist, fx.RUN_DATE))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        other = flatten_history(snapshot.snapshot_merge(norm.repartition(5), hist.repartition(2), fx.RUN_DATE))
        assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_only_scans_of_some_size_and_few_partitions_are_dealt_out(spark):
    from tessera.sources.spread import spread

    def dealt(df):
        return "RoundRobin" in spread(df)._jdf.queryExecution().executedPlan().toString()

    large = spark.range(0, 4_000_000, 1, 3)
    assert dealt(large) and not dealt(spark.range(0, 4_000_000, 1, 200)) and not dealt(spark.range(0, 1000, 1, 1))
    assert spread(large).count() == 4_000_000


def test_a_table_of_several_files_is_read_as_it_lies(spark, tmp_dir):
    """Files that give most cores their share need no exchange; one row group for all cores does."""
    from tessera.sources.spread import spread

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 2_000_000).selectExpr("id", "xxhash64(id) AS x")

    def dealt(name):
        return "RoundRobin" in spread(spark.read.parquet(f"{tmp_dir}/{name}"))._jdf.queryExecution().executedPlan().toString()

    rows.repartition(cores).write.parquet(f"{tmp_dir}/several")
    rows.coalesce(1).write.parquet(f"{tmp_dir}/one")
    assert dealt("one") or cores <= 2
    assert not dealt("several")


def test_key_filter_passes_every_key_and_few_others(spark):
    from tessera.operators.key_filter import key_filter

    keys = spark.range(5000).selectExpr("CASE WHEN id % 100 = 0 THEN NULL ELSE cast(id AS string) END AS id")
    others = spark.range(0, 20_000).selectExpr("cast(id AS string) AS id").unionByName(spark.range(3).selectExpr("cast(NULL AS string) AS id"))
    passed = {r.id for r in others.where(key_filter(keys, "id")(F.col("id"))).collect()}
    held = {r.id for r in keys.where("id IS NOT NULL").collect()}
    assert held <= passed and None not in passed and len(passed - held) < 0.1 * 15_000
    assert others.where(key_filter(keys.limit(0), "id")(F.col("id"))).count() == 0
    assert held <= {r.id for r in others.where(key_filter(keys, "id", most_bits=1024)(F.col("id"))).collect()}  # full, but never wrong


def test_history_is_filtered_before_its_exchange(spark, tmp_dir):
    from tessera.operators.quality import empty_history
    from tessera.schemas import SILVER_SCHEMA
    from tessera.sinks.publish import publish
    from tessera.sources.history import read_history

    rows = hist_df(spark, [(str(i), "app", "pf", "4", "2024-01-01T00:00:00Z", f"T{d}", "S", f"2024010{d}") for i in range(2000) for d in (1, 2)])
    for d in ("20240101", "20240102"):
        publish(rows.where(F.col("odate") == d).withColumn("historical_data", empty_history()).select(*[f.name for f in SILVER_SCHEMA.fields]), tmp_dir, d)
    history = read_history(spark, tmp_dir, "20240103")
    new = new_df(spark, [("a", str(i), "2024-01-01T00:00:00Z", "app", "pf", "4", 1, "T", "S") for i in range(0, 400, 4)])
    filtered = snapshot.snapshot_merge(new, history, "20240103", "left_outer", filter_history=True)
    plan = filtered._jdf.queryExecution().executedPlan().toString().split("\n")
    at = [i for i, line in enumerate(plan) if "Filter" in line and "Subquery" in line]
    scans = [i for i, line in enumerate(plan) if "FileScan" in line]
    exchanges = [i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert at and any(e < at[0] < s for e in exchanges for s in scans)  # exchange above, scan below
    plain = snapshot.snapshot_merge(new, history, "20240103", "left_outer")
    assert filtered.exceptAll(plain).count() == 0 and plain.exceptAll(filtered).count() == 0 and plain.count() == 100


def test_thin_history_gives_the_same_merge(spark):
    """Texts that stand on several days, in the batch, in one of two rows of an id, nowhere else, or are null."""
    import random

    rng = random.Random(11)
    texts = ["a", "b", "c", "", None]
    days = [(str(i), "app", "pf", rng.choice("45"), f"2024-01-0{rng.randrange(1, 3)}", rng.choice("TU"), rng.choice(texts), f"2024010{d}")
            for i in range(60) for d in (1, 2, 3) for _ in range(rng.choice((0, 1, 1, 2)))]
    hist = hist_df(spark, [*days, (None, "app", "pf", "4", "x", "T", "a", "20240101")])
    new = new_df(spark, [("av", str(i) if i != 7 else None, f"2024-01-0{rng.randrange(1, 3)}", "app", "pf", "4", 1, "T", rng.choice(texts)) for i in range(0, 70, 2) for _ in range(rng.choice((1, 1, 2)))])
    for how in ("full_outer", "left_outer"):
        for cut in (None, "20240103"):
            held = []
            thin = snapshot.snapshot_merge(new, hist, cut, how, thin_history=held)
            plain = snapshot.snapshot_merge(new, hist, cut, how)
            assert thin.schema.simpleString() == plain.schema.simpleString()
            assert thin.exceptAll(plain).count() == 0 and plain.exceptAll(thin).count() == 0 and thin.count() > 30
            for frame in held:
                frame.unpersist()


def test_a_run_exchanges_the_texts_of_the_batch_and_what_it_lacks(spark, tmp_dir):
    """Two earlier days with the same long texts as the batch are not exchanged beside it."""
    import random

    from test_versions import shuffled_bytes
    from tessera.plans import silver_job
    from tessera.sinks.publish import publish
    from tessera.sources.bronze import BRONZE_SCHEMA

    rng = random.Random(6)
    rows = [("av", "2024-01-03", str(i), "2024-01-03", 1, 4.0, None, "".join(rng.choice("ABCDEFGHIJKLMNOP") for _ in range(20_000)), "T") for i in range(200)]
    spark.createDataFrame(rows, BRONZE_SCHEMA).drop("response").write.parquet(f"{tmp_dir}/googlePlay/app_pf/odate=20240103")
    for d in (1, 2):
        past = spark.createDataFrame([(r[2], "app", "pf", str(d), "2024-01-01", "T", r[7]) for r in rows], "id string, app string, segmento string, rating string, iso_date string, title string, snippet string")
        publish(past, f"{tmp_dir}/silver", f"2024010{d}")
    _, at = shuffled_bytes(spark)
    r = silver_job.run(spark, silver_job.JobConfig(f"{tmp_dir}/googlePlay", f"{tmp_dir}/silver", f"{tmp_dir}/quarantine", "20240103"))
    assert r.valid_rows == 200
    assert shuffled_bytes(spark, at)[0] < 1.5 * 4_000_000


def test_the_salted_join_exchanges_each_side_once(spark):
    new = new_df(spark, [("av", str(i % 40), "2024-01-03", "app", "pf", "4", i, "T", "s") for i in range(50)])
    hist = hist_df(spark, [(str(i % 30 if i % 2 else 3), "app", "pf", "4", "2024-01-01", f"T{i}", "s", f"2024010{1 + i % 2}") for i in range(300)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = snapshot.salted_history_join(new, hist, 10)
        assert salted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        plain = snapshot.history_join(new, hist, "left_outer")
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0 and salted.count() > 150
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
