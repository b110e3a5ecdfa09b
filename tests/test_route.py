"""Routing rules, branch by branch."""

import pytest

from engage.operators import audit, enrich, route
from engage.plans import fixtures, routing
from tests.conftest import as_set

SCHEMA = (
    "call_id int, path string, direction string, duration string, cd6 string, cd10 string, cd48 string, cd69 string, "
    "cd93 string, org_id string, finance_lob string"
)


def calls(spark, *rows):
    """Calls with defaults: inbound, two minutes, no codes."""
    base = dict(path="/in/Member_1.json", direction="1", duration="120", cd6=None, cd10="", cd48="", cd69="", cd93="",
                org_id="", finance_lob=None)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    data = [tuple({**base, "call_id": i, **row}[n] for n in names) for i, row in enumerate(rows)]
    df = route.gate(spark.createDataFrame(data, SCHEMA))
    return df.withColumn("finance_known", df["finance_lob"].isNotNull())


def decisions(df):
    return sorted(as_set(df.select("call_id", "selected", "reason", "lob")))


def lookup_a(spark):
    return spark.createDataFrame(
        [(1, "MA", "skill", "1060"), (2, "IFP", "skill", "1060"), (3, "Broker", "skill", "1061"),
         (5, "MediCal", "skill", "1062"), (5, "MediCal", "queue", "Q1"), (5, "MediCal", "skill", "1062")],
        "ord int, lob string, kind string, key string",
    )


def orgs(spark):
    return spark.createDataFrame([("805001",)], "org_id string")


@pytest.mark.parametrize(
    "direction, duration, reason",
    [
        ("1", "61", None),
        ("1", "60", route.DURATION),
        ("1", None, route.DURATION),
        ("1", "long", route.DURATION),
        ("2", "61", route.DIRECTION),
        ("2", "10", route.DIRECTION),
        (None, "61", route.DIRECTION),
        ("", "61", route.DIRECTION),
        ("x", "61", route.DIRECTION),
    ],
)
def test_gate(spark, direction, duration, reason):
    row = calls(spark, {"direction": direction, "duration": duration}).first()
    assert row["gate_reason"] == reason


def test_member_key_takes_first_non_empty(spark):
    df = calls(spark, {"cd48": "a", "cd93": "b"}, {"cd93": "b", "cd6": "c"}, {"cd6": "c"}, {"cd6": ""})
    assert [r["member_key"] for r in df.orderBy("call_id").collect()] == ["a", "b", "c", None]


def test_multi_route_gives_a_row_per_lob(spark):
    df = calls(
        spark,
        {"cd10": "1060", "cd48": "m", "org_id": "805009", "finance_lob": "Individual (IFP)"},
        {"cd10": "1060", "cd48": "m", "org_id": "805001", "finance_lob": "Large Group"},
        {"cd10": "1060", "cd48": "m", "org_id": "805009", "finance_lob": " "},
        {"cd10": "1060", "cd48": "m", "org_id": "805009", "finance_lob": "GMAPD"},
        {"cd10": "1060", "cd48": "m", "finance_lob": None},
        {"cd10": "1060"},
        {"cd10": "1061", "cd48": "m", "finance_lob": "Large Group"},
        {"cd10": "1062", "cd69": "Q1"},
        {"cd10": "9999", "cd69": "Q1"},
        {"cd10": "9999"},
        {"cd10": "1060", "duration": "5"},
    )
    either, full = route.SKILL_OR_ORG, route.SKILL_ORG_FINANCE
    assert decisions(route.multi_route(df, lookup_a(spark), orgs(spark))) == sorted([
        (0, False, route.ORG_MISS, ""), (0, True, full, "IFP"),
        (1, False, route.FINANCE_MISS, ""),
        (2, True, full, "MA"), (2, True, full, "IFP"),
        (3, True, full, "MA"), (3, False, route.FINANCE_MISS, ""),
        (4, True, full, "MA"), (4, True, full, "IFP"),
        (5, True, either, "MA"), (5, True, either, "IFP"),
        (6, True, either, "Broker"),
        (7, True, either, "MediCal"),
        (8, True, either, "MediCal"),
        (10, False, route.DURATION, ""),
    ])


def test_multi_route_keeps_both_unselected_rows(spark):
    df = calls(spark, {"cd10": "1060", "cd48": "m", "org_id": "805001", "finance_lob": "Large Group"})
    rows = route.multi_route(df, lookup_a(spark), orgs(spark)).select("selected", "lob").collect()
    assert [tuple(r) for r in rows] == [(False, ""), (False, "")]


def test_first_match(spark):
    lookup = spark.createDataFrame(
        [("Provider", "1060"), ("IFP", "1061"), ("Core Premier", "1061"), ("Core Premier", "1062"), ("IFP", "bad")],
        "lob string, key string",
    )
    df = calls(
        spark,
        {"path": "/in/PROVIDER_1.json", "cd10": "1060"},
        {"path": "/in/provider_member.json", "cd10": "1061"},
        {"path": "/Member/x.json", "cd10": "1061"},
        {"path": "/in/member.json", "cd10": "1062"},
        {"path": "/in/member.json", "cd10": "1060"},
        {"path": "/in/member.json", "cd10": ""},
        {"path": "/in/member.json", "cd10": "bad"},
        {"path": "/in/other.json", "cd10": "1061"},
        {"path": "/in/member.json", "cd10": "1061", "direction": "2"},
        {"path": "/in/member.json", "cd10": "01061"},
    )
    assert decisions(route.first_match(df, lookup)) == [
        (0, True, "Filtered for Provider", "Provider"),
        (1, False, route.NOT_PROVIDER, ""),
        (2, True, "Filtered for IFP", "IFP"),
        (3, True, "Filtered for Core Premier", "Core Premier"),
        (4, False, route.SKILL_MISS, ""),
        (5, False, route.SKILL_MISS, ""),
        (6, False, route.SKILL_MISS, ""),
        (7, False, route.FILENAME, ""),
        (8, False, route.DIRECTION, ""),
        (9, True, "Filtered for IFP", "IFP"),
    ]


def test_ordered_prefix(spark):
    lookup = spark.createDataFrame(
        [(2, "1060", "Broker"), (1, "1060", "IFP On"), (3, "1061", "Small Group IFP"), (4, "1062", "Other")],
        "ord int, skill_id string, lob_text string",
    )
    df = calls(
        spark,
        {"cd10": "1060"},
        {"cd10": "1060", "cd48": "m", "finance_lob": ""},
        {"cd10": "1060", "cd48": "m", "finance_lob": None},
        {"cd10": "1061"},
        {"cd10": "1062"},
        {"cd10": ""},
        {"cd10": "7"},
    )
    assert decisions(route.ordered_prefix(df, lookup, order="ord")) == [
        (0, True, route.SKILL, "IFP"),
        (1, True, route.SKILL_FINANCE, "IFP"),
        (2, True, route.SKILL, "IFP"),
        (3, True, route.SKILL, "Small Group"),
        (4, False, route.SKILL_MISS, ""),
        (5, False, route.LOB_CONDITIONS, ""),
        (6, False, route.SKILL_MISS, ""),
    ]


# Expected rows per reason on the 0.01 tables, each rule over its own feed.
EXPECTED = {
    "A": {"Filtered for skill id or org id": 1027, "Filtered for skill id, org id, and finance lob": 472,
          "Not filtered due to direction condition": 1000, "Not filtered due to duration condition": 520,
          "Not filtered due to finance lob not matched": 259, "Not filtered due to org id not matched": 113},
    "B": {"Filtered for Provider": 132, "Filtered for IFP": 158, "Filtered for Core Premier": 85,
          "Not filtered due to direction condition": 1002, "Not filtered due to duration condition": 505,
          "Not filtered due to filename conditions": 404, "Not filtered due to not provider transcripts.": 374,
          "Not filtered due to skill id not matched": 673},
    "C": {"Filtered for skill id and finance lob": 616, "Filtered for skill id": 98,
          "Not filtered due to LOB conditions": 112, "Not filtered due to direction condition": 998,
          "Not filtered due to duration condition": 482, "Not filtered due to skill id not matched": 1027},
}


def test_reason_counts_per_feed(spark):
    rows = routing._all_feeds(spark, "/root/testdata/sf0.01").groupBy("feed", "reason").count().collect()
    found = {}
    for r in rows:
        found.setdefault(r["feed"], {})[r["reason"]] = r["count"]
    assert found == EXPECTED


def test_one_row_per_call_for_single_match_rules(spark):
    folder = "/root/testdata/sf0.001"
    n = fixtures.table(spark, folder, "events").count()
    for rule in (routing.route_first_match, routing.route_ordered_prefix):
        rows = rule(spark, folder)
        assert rows.count() == rows.select("call_id").distinct().count() == n


def test_audit_defaults_and_passthrough(spark):
    documents = spark.createDataFrame(
        [("/a/b/c.json", {"CD10": "1060", "zone": "west", "Direction": "1", "Duration_seconds": "90"}), ("/a/d.json", {})],
        "path string, metadata map<string,string>",
    )
    assert route.codes(documents, drop_empty=True).count() == 1
    gated = route.gate(route.codes(documents))
    known = enrich.with_finance_lob(
        gated, spark.createDataFrame([], "member_id string, finance_lob string")
    )
    routed = route.ordered_prefix(known, spark.createDataFrame([(1, "1060", "IFP")], "ord int, skill_id string, lob_text string"))
    rows = {r["filename"]: r for r in route.widen_metadata(route.audit_rows(routed, "feed-c", "2024-02-03"), ["zone"]).collect()}
    first, second = rows["c.json"], rows["d.json"]
    assert (first["language"], first["media_id"], first["length"], first["zone"]) == ("en-US", "", "0", "west")
    assert (first["is_selected"], first["selected_lob"], first["finance_lob"]) == ("Yes", "IFP", "Not Available")
    assert (second["is_selected"], second["direction"], second["zone"]) == ("No", "0", None)
    assert str(first["run_date"]) == "2024-02-03"


def test_daily_log_counts_blank_ids_as_absent(spark):
    rows = spark.createDataFrame(
        [("IFP", "2024-01-01", "feed-a", "1", " ", "", "x", None, None, "61"),
         ("IFP", "2024-01-01", "feed-a", "2", "7", "q", "", "", None, "60"),
         ("IFP", "2024-01-02", "feed-a", "1", "7", "q", "", "", "z", "90"),
         ("IFP", "2024-01-01", "other", "1", "7", "q", "", "", "z", "90")],
        "selected_lob string, run_date string, source string, direction string, cd10_skill_id string, "
        "cd69_queue_name string, cd48_member_id string, cd93_subscriber_id string, cd6_subscriber_id string, duration_seconds string",
    )
    log = audit.daily_log(rows, "%feed%", "2024-01-01", started="2024-01-01 00:00:00", ended="2024-01-01 01:00:00")
    assert tuple(log.first())[:9] == ("IFP", "2024-01-01", 2, 1, 1, 1, 1, 1, 1)
    text = audit.as_text_counts(log)
    assert dict(text.dtypes)["total_transcript_count"] == "string"
    assert text.first()["llm_processed_transcript_count"] is None
    bare = audit.daily_log(rows.select("selected_lob", "run_date", "source"), run_date="2024-01-02").first()
    assert (bare["total_transcript_count"], bare["skill_id_present"], bare["member_id_present"]) == (1, 0, 0)


def test_finance_prefix_match(spark):
    df = calls(spark, {"cd93": "123456789"}, {"cd48": "12345678901"})
    df = df.drop("finance_lob", "finance_known")
    lobs = spark.createDataFrame([("12345678901", "GMAPD")], "member_id string, finance_lob string")
    exact = enrich.with_finance_lob(df, lobs).orderBy("call_id").collect()
    prefix = enrich.with_finance_lob(df, lobs, match="prefix").orderBy("call_id").collect()
    assert [r["finance_lob"] for r in exact] == [None, "GMAPD"]
    assert [r["finance_lob"] for r in prefix] == ["GMAPD", "GMAPD"]
