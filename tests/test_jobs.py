"""The four jobs end to end on small frames."""

import datetime as dt
import json

from pyspark.sql import functions as F

from engage.operators import audit, labels, model, rag, route
from engage.plans import jobs
from tests.conftest import as_set


def document(**metadata):
    return json.dumps({"language": "en-US", "metadata": metadata})


def test_route_feed(spark, tmp_path):
    good = dict(Direction="1", Duration_seconds="90", CD10="1060", CD48="00000000101")
    bodies = spark.createDataFrame(
        [
            ("/in/a.json", document(**good)),
            ("/in/b.json", document(**{**good, "Direction": "2"})),
            ("/in/c.json", "{broken"),
            ("/in/d.json", document()),
        ],
        "path string, body string",
    )
    members = spark.createDataFrame(
        [("000000001", "01", "GMAPD", dt.date(2024, 1, 1)), ("000000001", "01", "Large Group", dt.date(2023, 1, 1))],
        "subscriber_id string, mbr_sfx string, finance_lob string, study_period date",
    )
    lookup = spark.createDataFrame([(1, "MA", "skill", "1060"), (2, "IFP", "skill", "1060")], "ord int, lob string, kind string, key string")
    orgs = spark.createDataFrame([("805001",)], "org_id string")
    paths = str(tmp_path / "audit"), str(tmp_path / "routed")
    log = jobs.route_feed(
        bodies, members, lambda c: route.multi_route(c, lookup, orgs), "feed-a", "2024-05-06", *paths, drop_empty=True
    )
    rows = spark.read.parquet(paths[0])
    assert as_set(rows.select("filename", "is_selected", "selected_lob", "finance_lob")) == {
        ("a.json", "Yes", "MA", "GMAPD"), ("a.json", "No", "", "GMAPD"), ("b.json", "No", "", "GMAPD"),
    }
    assert as_set(spark.read.parquet(paths[1]).select("lob", "feed", "path")) == {("MA", "feed-a", "/in/a.json")}
    assert as_set(log.select("selected_lob", "total_transcript_count", "outbound_calls_count")) == {("MA", 1, 0), ("", 2, 1)}


def test_churn_job(spark):
    n = 400
    d = "date'{}'".format
    base = spark.range(n).selectExpr(
        "cast(id as string) member_id", "'IFP' markets_lob", "cast(id % 7 as string) zipcode",
        "case when id % 4 <> 0 then cast(id % 5 as string) end prov_ipa_id", "cast(id % 50 as int) age",
        "40 + id % 9 / 10.0 latitude", "-120 + id % 9 / 10.0 longitude", "cast(null as double) nothing",
    )
    frames = []
    for year in (2022, 2023):
        first, last = d(f"{year - 1}-03-01"), d(f"{year + 1}-06-30")
        frames.append(base.selectExpr("*", f"{d(f'{year}-12-31')} study_end_dt", f"date_sub({first}, age) first_elig_month_start_dt", f"{last} last_elig_month_end_dt"))
        stays = base.where("age > 20 or cast(member_id as int) % 11 = 0")
        frames.append(stays.selectExpr("*", f"{d(f'{year + 1}-01-31')} study_end_dt", f"{first} first_elig_month_start_dt", f"{last} last_elig_month_end_dt"))
    members = frames[0]
    for frame in frames[1:]:
        members = members.unionByName(frame)
    income = spark.range(7).selectExpr("cast(id as string) zipcode", "id * 1000.5 income")
    providers = spark.range(4).selectExpr("cast(id as string) facets_prov_id", "41.0d home_latitude", "-119.0d home_longitude")
    cycles = [labels.year_cycle(y) for y in (2022, 2023)]
    both = [providers.where("facets_prov_id < 2"), providers.where("facets_prov_id >= 2")]
    assert "nothing" in jobs.feature_table(members, cycles).columns
    table = jobs.feature_table(members, cycles, by_zip=[income], providers=both, drop_empty=True)
    assert table.count() == 2 * n and "nothing" not in table.columns
    assert as_set(table.groupBy("provider_flag", "matched").count()) == {(1, 1, 480), (1, 0, 120), (0, 0, 200)}
    ready = jobs.trim_and_derive(table)
    kept = ready.count()
    assert 0 < kept < 2 * n and {"pcp_distance", "tenure"} <= set(ready.columns)
    keyed = ready.withColumn("key", F.concat_ws("/", "member_id", "open_enrollment_cycle"))
    fitted, reports = jobs.train_and_backtest(
        keyed, ["age", "income", "pcp_distance", "tenure", "zipcode"], "key", "open_enrollment_cycle", "2023",
        trials=2, rounds=(3, 4), folds=2,
    )
    assert reports["trials"].count() == 2 and 0.5 < reports["folds"].first()[0] <= 1
    assert reports["holdout_auc"].first()[0] > 0.9 and reports["backtest_auc"].first()[0] > 0.9
    best = reports["importance"].orderBy(F.desc("importance")).first()["feature"]
    assert best in ("age", "tenure")
    confusion = reports["backtest_confusion"].agg(F.sum("n")).first()[0]
    assert confusion == keyed.where("open_enrollment_cycle = '2022'").count()
    assert reports["backtest_lift"].agg(F.sum("count")).first()[0] == confusion
    assert model.select_features(keyed, ["age"], ["key"]).columns == ["key", "age"]


def test_answer_job(spark):
    docs = spark.createDataFrame([(1, "plan premiums rise"), (2, "claims denied again"), (3, "hello world")], "doc_id long, text string")
    chunks = rag.chunk(docs)
    embedder = rag.fit_embedder(chunks, "chunked_text", 64)
    index = rag.embed(chunks, "chunked_text", embedder)
    chat = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "user", "claims denied")], "conv_id long, turn long, role string, text string")
    rows = jobs.answer_prompts(chat, index, embedder, k=1).orderBy("position").collect()
    assert "Passage: claims denied again\n" in rows[0]["content"]
    assert [(r["role"], r["content"]) for r in rows[1:]] == [("user", "hi"), ("user", "claims denied")]
    shout = lambda asked: asked.where("branch = 'rewrite'").groupBy("conv_id").agg(F.lit("premiums").alias("question"))
    rows = jobs.answer_prompts(chat, index, embedder, rewriter=shout, k=1).orderBy("position").collect()
    assert "Passage: plan premiums rise\n" in rows[0]["content"]


def test_score_and_log_job(spark, tmp_path):
    work = spark.createDataFrame([("a", "ok"), ("b", "bad"), ("c", "ok")], "id string, text string")

    def scorer(name, text):
        if text == "bad":
            raise ValueError("unreadable")
        return json.dumps({"mood": {"score": len(name)}, "tags": ["x", "y"] if name == "a" else []})

    log = audit.StageLog(spark)
    table = str(tmp_path / "table")
    metal = spark.createDataFrame([("a", "gold")], "id string, metal string")
    scored = jobs.score_and_enrich(
        work, scorer, "mood struct<score: int>, tags array<string>",
        [(metal, "id", {"metal": "Not Available"}), (None, "id", {"nps": 0})],
        {"tags": "none"}, "2024-05-06", table, log,
    )
    assert as_set(scored.select("id", "status", "error_message")) == {
        ("a", "Success", None), ("b", "Failed", "unreadable"), ("c", "Success", None),
    }
    assert as_set(spark.read.parquet(table).select("id", "mood_score", "tags", "metal", "nps")) == {
        ("a", 1, "x", "gold", 0), ("a", 1, "y", "gold", 0), ("c", 1, "none", "Not Available", 0),
    }
    keys = ["lob", "day", "feed"]
    daily = spark.createDataFrame([("Core", "d1", "A", "5"), ("IFP", "d1", "A", "6"), (None, "d1", "A", "7")], "lob string, day string, feed string, total string")
    counts = spark.createDataFrame([("Core", "d1", "A", "2"), ("New", "d1", "A", "9")], "lob string, day string, feed string, processed string")
    times = audit.stage_times(log.frame(), {"NLP Processing": "nlp"})
    stamped = spark.createDataFrame([("Core", "d1", "A"), ("Extra", "d1", "A")], "lob string, day string, feed string").withColumns(
        {c: F.lit(times.first()[c]) for c in times.columns}
    )
    rows = {r["lob"]: r for r in jobs.update_log(daily, keys, counts, stamped).collect()}
    assert set(rows) == {"Core", "IFP", None, "Extra"}
    assert (rows["Core"]["processed"], rows["IFP"]["processed"], rows["Extra"]["total"]) == ("2", None, None)
    assert rows["Core"]["nlp_start_time"] and rows["Extra"]["nlp_end_time"] and rows["IFP"]["nlp_start_time"] is None


def test_read_docs(spark, tmp_path):
    (tmp_path / "one.txt").write_text("line one\nline two")
    assert rag.read_docs(spark, str(tmp_path)).first()["text"] == "line one\nline two"


def test_route_feed_keeps_everything_and_reruns_replace(spark, tmp_path):
    good = dict(Direction="1", Duration_seconds=90.5, CD10="1060", zone="west")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    rows = [("/in/a.json", document(**good), None), ("/in/b.json", "{broken", None), ("/in/z.zip", None, "no zip")]
    schema = "path string, body string, error string"
    bodies = spark.createDataFrame(rows, schema).mapInPandas(counted, schema)
    members = spark.createDataFrame([], "subscriber_id string, mbr_sfx string, finance_lob string, study_period date")
    lookup = spark.createDataFrame([(1, "Broker", "skill", "1060")], "ord int, lob string, kind string, key string")
    orgs = spark.createDataFrame([("805001",)], "org_id string")
    paths = {n: str(tmp_path / n) for n in ("audit_path", "routed_path", "errors_path", "log_path")}
    for run in (1, 2):
        jobs.route_feed(bodies, members, lambda c: route.multi_route(c, lookup, orgs), "feed-a", "2024-05-06", **paths)
        assert reads.value == 3 * run
    audited = spark.read.parquet(paths["audit_path"]).collect()
    assert [(r["is_selected"], r["other_metadata"]["zone"]) for r in audited] == [("Yes", "west")]
    routed = spark.read.parquet(paths["routed_path"]).collect()
    assert [r["document"] for r in routed] == [document(**good)]
    failed = {(r["path"], r["error"]) for r in spark.read.parquet(paths["errors_path"]).collect()}
    assert failed == {("/in/b.json", "not a JSON document"), ("/in/z.zip", "no zip")}
    assert spark.read.parquet(paths["log_path"]).count() == 1
