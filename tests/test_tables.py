"""Preparation, sinks, merges and joins on hand-made frames."""

import datetime as dt
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F, types as T

from engage.operators import audit, enrich, labels, merge, prep, skew
from engage.sources import folders, lookups, sinks
from tests.conftest import as_set


def test_sanitize_names_are_unique():
    assert sinks.sanitize_names(["a b", "a,b", "a;b", "a=b", "c\n"]) == ["a_b", "a_b_dup", "a_b_dup2", "a_b_dup3", "c_"]
    assert sinks.sanitize_names(["x", "x_dup", "x"]) == ["x", "x_dup", "x_dup2"]


def test_align_to_schema(spark):
    target = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a", T.StringType()), T.StructField("z", T.DateType())])
    df = sinks.align_to_schema(spark.createDataFrame([(1, "7", 2.0), (2, "x", 3.0)], "a int, b string, extra double"), target)
    assert df.schema.simpleString() == "struct<b:int,a:string,z:date>"
    assert as_set(df) == {(7, "1", None), (None, "2", None)}


def test_append_creates_then_aligns(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.append_aligned(spark.createDataFrame([(1, "a")], "id int, `the name` string"), path) == "created"
    assert sinks.append_aligned(spark.createDataFrame([("2", 5)], "id string, other int"), path) == "appended"
    assert as_set(spark.read.parquet(path)) == {(1, "a"), (2, None)}


def test_add_table_columns(spark):
    spark.sql("create table log_t (lob string) using parquet")
    assert sinks.add_table_columns(spark, "log_t", {"start": "string", "LOB": "string"}) == ["start"]
    assert sinks.add_table_columns(spark, "log_t", {"start": "string"}) == []
    assert spark.table("log_t").columns == ["lob", "start"]


def test_write_routed_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "routed")
    df = spark.createDataFrame([("IFP", "2024-01-01", "A", 1), ("MA", "2024-01-01", "A", 2)], "lob string, run_date string, feed string, n int")
    sinks.write_routed(df, path)
    sinks.write_routed(df.where("lob = 'MA'").withColumn("n", F.lit(9)), path)
    assert {(r["lob"], r["n"]) for r in spark.read.parquet(path).collect()} == {("IFP", 1), ("MA", 9)}


def test_upsert_updates_and_inserts_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, None), (3, "c"), (None, "m"), (None, "m2")], "k int, v string")
    once = merge.upsert(target, source, "k")
    assert as_set(once) == {(1, "a"), (2, None), (3, "c"), (None, "n"), (None, "m"), (None, "m2")}
    keyed = source.where("k is not null")
    assert as_set(merge.upsert(merge.upsert(target, keyed, "k"), keyed, "k")) == as_set(merge.upsert(target, keyed, "k"))
    assert as_set(merge.upsert(target, source, "k", insert=False)) == {(1, "a"), (2, None), (None, "n")}


def test_upsert_rejects_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="more than one source row"):
        merge.upsert(target, source, "k").collect()


def test_change_feed(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 2)], "k int, v string, n int")
    after = spark.createDataFrame([(1, "a", None), (2, "b", None), (4, "d", 4)], "k int, v string, n int")
    assert as_set(merge.change_feed(before, after, "k")) == {(2, "update", "b", None), (3, "delete", "c", 2), (4, "insert", "d", 4)}
    assert merge.change_feed(after, after, "k").isEmpty()


def test_drop_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"]).toDF("a", "b", "a")
    assert prep.drop_duplicate_columns(df).collect() == [(1, 2)]
    assert prep.drop_duplicate_columns(df, "none").columns == ["b"]


def test_drop_matching_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["MEMBER_ID", "valid", "AGE", "TENURE"])
    assert prep.drop_matching(df, also=["AGE"]).columns == ["valid", "TENURE"]


def test_fill_constant_fills_nan_and_null(spark):
    df = spark.createDataFrame([(math.nan, None, None), (1.0, 2, "x")], "d double, i bigint, s string")
    assert as_set(prep.fill_constant(df)) == {(-1.0, -1, "missing"), (1.0, 2, "x")}


def test_impute_median(spark):
    df = spark.createDataFrame([(1.0, 1), (4.0, None), (9.0, 3), (None, 5), (math.nan, 8)], "d double, i int")
    assert sorted(tuple(r) for r in prep.impute_median(df, ["d", "i"]).collect()) == [(1.0, 1), (4.0, 3), (4.0, 5), (4.0, 8), (9.0, 3)]


def test_non_null_columns(spark):
    df = spark.createDataFrame([(math.nan, 1, None)], "d double, i int, n double")
    assert as_set(prep.non_null_columns(df)) == {("d", 0), ("i", 1), ("n", 0)}
    assert prep.drop_empty_columns(df).columns == ["i"]


def test_tenure_and_distance(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-03-01"), ("oops", "2024-03-01")],
                               "first_elig_month_start_dt string, last_elig_month_end_dt string")
    assert [r["tenure"] for r in prep.tenure(df).collect()] == [60, None]
    geo = spark.createDataFrame(
        [(1, "0", "0", "0", "1"), (1, "0", "0", "0", "3"), (1, "0", "0", "0", "2"), (0, "0", "0", "0", "50"), (1, "x", "0", "0", "1")],
        "provider_flag int, latitude string, longitude string, home_latitude string, home_longitude string",
    )
    degree = 3958.8 * math.pi / 180
    miles = [r["pcp_distance"] for r in prep.distance_feature(geo).collect()]
    assert miles[:4] == pytest.approx([degree, 3 * degree, 2 * degree, 2 * degree]) and miles[4] is None


def test_trim_quantiles_drops_nulls_and_tails(spark):
    df = spark.range(100).selectExpr("case when id = 50 then null else cast(id as double) end x")
    kept = sorted(r["x"] for r in prep.trim_quantiles(df, "x", 0.05, 0.95).collect())
    values = [float(i) for i in range(100) if i != 50]
    assert kept == [v for v in values if values[math.ceil(0.05 * 99) - 1] <= v <= values[math.ceil(0.95 * 99) - 1]]


def test_approx_quantile_within_error(spark):
    got = {r["prob"]: r["value"] for r in prep.approx_quantile(spark.range(10001).selectExpr("id x"), ["x"], [0.25, 0.5]).collect()}
    assert abs(got[0.25] - 2500) <= 101 and abs(got[0.5] - 5000) <= 101


def test_optional_enrichment(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    source = spark.createDataFrame([(1, "yes")], "k int, seen string")
    assert as_set(enrich.optional(df, source, "k", {"seen": "no"})) == {(1, "yes"), (2, "no")}
    off = enrich.optional(df, None, "k", {"score": [3, 5, 7]})
    assert {r["score"] for r in off.collect()} <= {3, 5, 7} and as_set(off) == as_set(off)


def test_flatten_keeps_rows_with_empty_arrays(spark):
    df = spark.createDataFrame([(1, ((2, [("x", 1)]),)), (2, ((3, []),))], "id int, o struct<p: struct<a: int, l: array<struct<s: string, n: int>>>>")
    flat = enrich.flatten(df)
    assert flat.columns == ["id", "o_p_a", "o_p_l_s", "o_p_l_n"]
    assert as_set(flat) == {(1, 2, "x", 1), (2, 3, None, None)}


def test_latest_lob_ties_and_filter(spark):
    rows = [("s", "02", "B", "2024-01"), ("s", "01", "A", "2024-01"), ("s", "00", "Z", "2023-12"), ("t", "01", "T", "2020-01")]
    df = spark.createDataFrame(rows, "subscriber_id string, mbr_sfx string, finance_lob string, study_period string")
    assert as_set(enrich.latest_lob(df)) == {("s01", "A"), ("t01", "T")}
    keys = spark.createDataFrame([("t",)], "member_key string")
    assert as_set(enrich.latest_lob(df, keys)) == {("t01", "T")}


def test_prefix_semi_join_keeps_repeats(spark):
    df = spark.createDataFrame([("123456789", "01", 1), ("123456789", "01", 1), ("123456789", "02", 2), ("999999999", "01", 3)],
                               "subscriber_id string, mbr_sfx string, n int")
    by_id = spark.createDataFrame([("12345678901",)], "member_key string")
    by_subscriber = spark.createDataFrame([("123456789",), ("12345678901",)], "member_key string")
    assert enrich.prefix_semi_join(df, by_id).count() == 2
    assert enrich.prefix_semi_join(df, by_subscriber).count() == 3


def test_salted_join_spreads_a_hot_key_and_changes_nothing(spark):
    left = spark.range(20000).selectExpr("id", "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id end k")
    right = spark.range(0, 20000, 2).selectExpr("id k", "id * 10 v").unionByName(spark.createDataFrame([(7, 70), (7, 71)], "k long, v long"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        ours = skew.salted_join(left, right, "k", how)
        plain = left.join(right, "k", how)
        assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.select(*ours.columns).collect()))
    hot = spark.range(1).select(skew.hot_key_salts(left, ["k"], 8).alias("h")).first()["h"]
    assert len(hot) == 2  # the key 7 and NULL
    assert max(hot.values()) > min(hot.values()) > 1
    big = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = skew.salted_join(left, right, "k", "left")
        assert rows.count() == left.join(right, "k", "left").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", big)


def test_salted_join_balances_a_third_of_the_rows(spark):
    left = spark.range(0, 90000, 1, 6).selectExpr("id", "case when id % 3 = 0 then 7 else id end k")
    right = spark.range(90000).selectExpr("id k", "id * 2 v")
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        share = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()) / 90000
        assert share(left.join(right, "k", "left")) > 0.33
        assert share(skew.salted_join(left, right, "k", "left")) < 0.25
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize(
    "left_type, right_type",
    [("int", "bigint"), ("bigint", "smallint"), ("decimal(10,0)", "decimal(20,0)"), ("int", "decimal(12,0)"), ("date", "timestamp")],
)
def test_joins_agree_on_differing_key_types(spark, left_type, right_type):
    number = lambda t: f"cast(date_add(date'2000-01-01', cast(k as int)) as {t})" if "dat" in left_type else f"cast(k as {t})"
    left = spark.range(2000).selectExpr("id", "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 900 end k")
    left = left.selectExpr("id", f"{number(left_type)} k")
    right = spark.range(900).selectExpr("id k", "id * 10 v").selectExpr(f"{number(right_type)} k", "v")
    for how in ("left", "inner", "left_semi", "left_anti"):
        want = sorted(map(str, left.join(right, "k", how).select("id").collect()))
        for join in (skew.salted_join, skew.keyed_join, lambda *a: skew.join_lookup(*a, small=True), lambda *a: skew.join_lookup(*a, small=False)):
            assert sorted(map(str, join(left, right, "k", how).select("id").collect())) == want


def test_joins_refuse_keys_without_a_common_type(spark):
    with pytest.raises(TypeError):
        skew.keyed_join(spark.range(3).selectExpr("id k"), spark.createDataFrame([("1",)], "k string"), "k")



@pytest.mark.parametrize("max_rows", [100_000, 10])
def test_rows_that_fan_out_are_dealt_over_the_tasks(spark, max_rows):
    left = spark.range(400).selectExpr("id", "if(id % 5 = 4, null, id % 5) as k").coalesce(1)
    dim = spark.range(900).selectExpr("id % 3 as d", "id as v")
    out = enrich.join_dim(left, dim, "k", "d", matched="hit", max_rows=max_rows)
    coalesce, broadcast = "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold"
    try:  # as with tables too large to be read as one part or broadcast
        spark.conf.set(coalesce, "false")
        spark.conf.set(broadcast, "-1")
        got = out.select("id", "k", "v", "hit", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset(coalesce)
        spark.conf.unset(broadcast)
    wanted = [(i, i % 5 if i % 5 < 4 else None, v, int(v is not None)) for i in range(400) for v in (range(i % 5, 900, 3) if i % 5 < 3 else [None])]
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted((tuple(r[:4]) for r in got), key=key) == sorted(wanted, key=key)
    per_task = Counter(r["task"] for r in got)
    assert len(per_task) > 3 and max(per_task.values()) < 0.3 * len(got)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_rows_of_a_lookup_beyond_the_bound_fan_out_by_runs_over_the_tasks(spark, how, broadcast):
    left = spark.range(64).selectExpr("id", "if(id % 4 = 3, null, id % 4) as k", "id % 2 as v").coalesce(1)
    # more than a run of key 0, rows that are equal, a key with one row, and none of key 2; a name of the left side
    rows = [(0, i, {"a": i}) for i in range(2500)] + [(0, 7, {"a": 7})] * 20 + [(1, None, None), (None, 1, None)]
    lookup = spark.createDataFrame(rows, "k long, v long, m map<string, long>")
    conf = {"spark.sql.autoBroadcastJoinThreshold": broadcast, "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        out = skew.join_repeated(left, lookup, "k", how, max_rows=10)
        assert out.columns == ["k", "id", "v", "v", "m"]
        out = out.toDF("k", "id", "l", "v", "m").withColumn("task", F.spark_partition_id())
        got = out.select("k", "id", "l", "v", F.col("m")["a"].alias("a"), "task").collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in conf:
            spark.conf.unset(name)
    wanted = Counter()
    for i in range(64):
        found = [(v, m and m["a"]) for k, v, m in rows if k is not None and k == i % 4]
        for v, a in found or [(None, None)] * (how == "left"):
            wanted[(i % 4 if i % 4 < 3 else None, i, i % 2, v, a)] += 1
    assert Counter(tuple(r[:5]) for r in got) == wanted
    per_task = Counter(r["task"] for r in got)
    assert len(per_task) > 3 and max(per_task.values()) < 0.4 * len(got)
    # a row meets runs, not rows
    assert plan.index("Generate inline") < plan.index("Join")


def test_join_lookup_beyond_the_bound(spark):
    left = spark.createDataFrame([(1,), (2,), (9,)], "k int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    small, large = skew.join_lookup(left, right, "k"), skew.join_lookup(left, right, "k", max_rows=1)
    assert as_set(small) == as_set(large) == {(1, "a"), (2, "b"), (9, None)}


def test_survival_reference_cycle(spark):
    d = dt.date
    rows = [
        ("a", "IFP", d(2021, 12, 31), d(2020, 1, 1), d(2022, 6, 30)),
        ("a", "IFP", d(2022, 1, 31), d(2020, 1, 1), d(2022, 6, 30)),
        ("b", "xIFPx", d(2021, 12, 31), d(2020, 1, 1), d(2021, 12, 31)),
        ("b", "IFP", d(2022, 1, 31), d(2020, 1, 1), d(2021, 12, 31)),
        ("c", "IFP", d(2021, 12, 31), d(2020, 1, 1), d(2022, 6, 30)),
        ("c", "MA", d(2022, 1, 31), d(2022, 1, 1), d(2022, 1, 1)),
        ("d", "MA", d(2021, 12, 31), d(2020, 1, 1), d(2022, 6, 30)),
        ("e", "IFP", d(2021, 12, 31), d(2020, 1, 1), d(2022, 6, 30)),
        ("e", "IFP", d(2021, 12, 31), d(2020, 1, 1), d(2022, 6, 30)),
        ("a", "IFP", d(2022, 12, 31), d(2020, 1, 1), d(2022, 6, 30)),
    ]
    df = spark.createDataFrame(rows, "member_id string, markets_lob string, study_end_dt date, first_elig_month_start_dt date, last_elig_month_end_dt date")
    out = labels.survival(df, [labels.year_cycle(2021), labels.year_cycle(2022)])
    got = sorted((r["member_id"], r["open_enrollment_cycle"], r["survival_flag"], r["churn_flag"]) for r in out.collect())
    assert got == [("a", "2021", 1, 0), ("a", "2022", 0, 1), ("b", "2021", 0, 1), ("c", "2021", 1, 0), ("e", "2021", 0, 1)]


def test_unprocessed_and_lagged(spark):
    found = spark.createDataFrame([("2024-01-03",), ("2024-01-01",), ("2024-01-02",)], "name string")
    done = spark.createDataFrame([("2024-01-01",), ("2024-01-01",)], "name string")
    assert [r[0] for r in folders.unprocessed(found, done, "name").collect()] == ["2024-01-02", "2024-01-03"]
    assert folders.lagged(found, "name", "2024-01-06", 4).collect() == [("2024-01-02",)]


def test_lookups(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Skill\n 12 \n13.0\n")
    (tmp_path / "o.csv").write_text("NAME,ID\nMember Medicare,1\nElse,2\n")
    (tmp_path / "t.csv").write_text("Skill_ID,LOB\n5,IFP\n5,Broker\n")
    skills = lookups.skill_lookup({"MA": lookups.read_sheet(spark, str(tmp_path / "s.csv"))})
    assert as_set(skills) == {(1, "MA", "skill", "10612"), (1, "MA", "skill", "10613")}
    assert as_set(lookups.org_ids(lookups.read_sheet(spark, str(tmp_path / "o.csv")))) == {("805001",)}
    text = lookups.skill_text_lookup(lookups.read_sheet(spark, str(tmp_path / "t.csv"))).orderBy("ord")
    assert [r["lob_text"] for r in text.collect()] == ["IFP", "Broker"]
    groups = lookups.hunt_group_lookup({"IFP": spark.createDataFrame([(4,)], "HuntGroup int")})
    assert as_set(groups) == {("IFP", "4")}


def test_partition_sizes_show_empty_partitions(spark):
    sizes = audit.partition_sizes(spark.range(0, 10, 1, 4).where("id < 3"))
    got = as_set(sizes)
    assert len(got) == 4 and sum(n for _, n in got) == 3 and any(n == 0 for _, n in got)


def test_stage_log_times_the_action(spark, tmp_path):
    log = audit.StageLog(spark)
    log.run("good", lambda: spark.range(5).count())
    with pytest.raises(ZeroDivisionError):
        log.run("bad", lambda: 1 / 0)
    path = str(tmp_path / "log")
    log.write(path)
    back = audit.read_stage_log(spark, path)
    assert {(r["stage"], r["status"]) for r in back.collect()} == {("good", "Success"), ("bad", "Failed")}
    times = audit.stage_times(back, {"good": "g", "never": "n"}).first()
    assert times["g_start_time"] and times["n_start_time"] is None
