"""Merges, change feeds, incremental pickup, file sinks and the scorer."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from engage.functions import rounded
from engage.operators import audit, keyed_table, merge, rag, score
from engage.operators.ranking import one_row
from engage.plans import jobs
from engage.plans.fixtures import derive, table, with_ctes
from engage.session import materialise, shared_dir
from engage.sources import archive_source, archives, documents, folders, lookups, sinks
from engage.streaming import changes, index_sync, pickup

TARGET = "SELECT CASE WHEN c_custkey % 40 = 1 THEN NULL ELSE c_custkey END AS k, c_acctbal AS bal, c_mktsegment AS seg FROM customer"
SOURCE = """
SELECT CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_custkey + 30 END AS k, CAST(count(*) AS DOUBLE) AS bal, max(o_orderpriority) AS seg
FROM orders GROUP BY o_custkey
"""
AFTER = """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_name NOT LIKE '%3'
UNION ALL SELECT s_suppkey + 100000000, s_acctbal, s_name FROM supplier
"""
# A log row per line of business, day and feed, and scored documents of two organisations.
DAILY = """
SELECT CASE event_type WHEN 'view' THEN 'Core Premier' WHEN 'click' THEN 'IFP' ELSE 'Broker' END AS lob, CAST(ts AS DATE) AS run_date,
       CASE WHEN user_id % 2 = 0 THEN 'S' ELSE 'other' END AS feed, CAST(count(*) AS STRING) AS total_transcript_count
FROM events GROUP BY 1, 2, 3
"""
PROCESSED = """
SELECT event_id AS id, CASE WHEN user_id % 3 = 0 THEN 'S' WHEN user_id % 3 = 1 THEN 'T' END AS org_id, CAST(ts AS DATE) AS processed_date
FROM events WHERE value > 1
"""
EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def upsert_matched(spark: SparkSession, folder: str) -> DataFrame:
    """Update only, with a condition on the target's own value."""
    bal = F.when(F.col("seg") == "BUILDING", F.col("_src_bal")).otherwise(F.col("bal"))
    return merge.upsert(derive(spark, folder, TARGET), derive(spark, folder, SOURCE), "k", {"bal": bal}, insert=False)


def upsert_insert(spark: SparkSession, folder: str) -> DataFrame:
    return merge.upsert(derive(spark, folder, TARGET), derive(spark, folder, SOURCE), "k")


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    before = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return merge.change_feed(before, derive(spark, folder, AFTER), "c_custkey")


def upsert_large(spark: SparkSession, folder: str) -> DataFrame:
    """An int-keyed target and a bigint-keyed source."""
    target = derive(spark, folder, TARGET).withColumn("k", F.col("k").cast("int"))
    return merge.upsert(target, derive(spark, folder, SOURCE), "k").withColumn("k", F.col("k").cast("long"))


def merge_parts(spark: SparkSession, folder: str) -> DataFrame:
    """A merge of a few customers' orders into a table of 64 parts, and how few of them it replaced."""
    path = shared_dir(spark, "parts")
    keyed_table.create(derive(spark, folder, TARGET), path, "k", 64)
    source = derive(spark, folder, SOURCE).where("k % 50 = 7 and k < 500")
    replaced = keyed_table.merge_into(spark, path, source)
    return keyed_table.read(spark, path).withColumn("few", F.lit(0 < len(replaced) <= 10))


def stream_changes(spark: SparkSession, folder: str) -> DataFrame:
    """An index fed by a stream: all documents; then those cut, gone or back, and no others."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    cut = docs.withColumn("text", F.array_join(F.slice(words, 1, 100), " "))
    waves = [docs, cut.where("doc_id % 5 = 0 and doc_id % 7 <> 0"), docs.where("doc_id = 7")]
    gone = [None, "doc_id % 7 = 0", None]
    source, index, ledger = (shared_dir(spark, n) for n in ("versions", "index", "ledger"))
    columns = [c.split()[0] for c in changes.VERSIONED.split(", ")]
    for version, (wave, lost) in enumerate(zip(waves, gone)):
        rows = rag.chunk(wave).withColumn("version", F.lit(version).cast("long"))
        if lost:
            tombs = docs.where(lost).select("doc_id", F.lit(version).cast("long").alias("version"))
            rows = rows.unionByName(tombs, allowMissingColumns=True)
        rows.select(*columns).write.mode("append").parquet(source)
        found = changes.sync_stream(spark, source, index, ledger, _word_counts)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("chunk_ix", "chunked_text"))), lambda c: c["chunked_text"])
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.sum(F.element_at("embedding", 1)).alias("words"),
        F.md5(F.array_join(texts, "|")).alias("text_hash"),
    )


def _word_counts(texts: pd.Series) -> list[list[float]]:
    return [[float(len(text.split())), 1.0] for text in texts]


def update_log(spark: SparkSession, folder: str) -> DataFrame:
    """A day's log per line of business and feed, the counts of scored documents merged into the rows they belong to."""
    daily = derive(spark, folder, DAILY)
    scored = derive(spark, folder, PROCESSED)
    counts = audit.processed_log(audit.processed_counts(scored, "S"), "Core Premier", "S", "other")
    times = daily.where("lob = 'Core Premier'").select("lob", "run_date", "feed").distinct().withColumn("nlp_end", F.lit("12:00"))
    return jobs.update_log(daily, ["lob", "run_date", "feed"], counts, times)


def unprocessed(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "customer").select(F.col("c_custkey").alias("name"))
    done = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("name"))
    return folders.unprocessed(found, done, "name")


def lagged_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Each feed's folder of its own lag before the last day of the events."""
    events = table(spark, folder, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    run = events.agg(F.max("day")).scalar()
    lag = F.when(F.col("event_type") == "view", 4).when(F.col("event_type") == "click", 5).otherwise(3)
    return folders.lagged(events, "day", run, lag).select("event_id", "event_type", "day")


def stream_new(spark: SparkSession, folder: str) -> DataFrame:
    """Pick the event file up, run again without news, and count what the table holds."""
    out, ledger = shared_dir(spark, "picked"), shared_dir(spark, "ledger")
    for _ in range(2):
        rows = pickup.stream_new(spark, folder, out, ledger, EVENT_SCHEMA, glob="events.parquet")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 2).alias("total"))


def sync_index(spark: SparkSession, folder: str) -> DataFrame:
    """Index the chunks of two languages, then a second wave that repeats one of them and adds the others."""
    chunks = rag.chunk(table(spark, folder, "documents"))
    embedder = rag.fit_embedder(chunks, "chunked_text", 64)
    source, index, ledger = (shared_dir(spark, n) for n in ("chunks", "index", "ledger"))
    for wanted in ("lang = 'en' or lang = 'de'", "lang <> 'en'"):
        wave = chunks.join(table(spark, folder, "documents").where(wanted).select("doc_id"), "doc_id", "left_semi")
        wave.select("chunk_id", "doc_id", "chunk_ix", "chunked_text").write.mode("append").parquet(source)
        rows = index_sync.sync_index(spark, source, index, ledger, embedder)
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"))


def sync_changes(spark: SparkSession, folder: str) -> DataFrame:
    """An index through three snapshots: all documents; some cut to their first window and some gone; one back again."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    shorter = F.when(F.col("doc_id") % 5 == 0, F.array_join(F.slice(words, 1, 100), " ")).otherwise(F.col("text"))
    cut = docs.withColumn("text", shorter)
    chunked = lambda d: rag.chunk(d).select("chunk_id", "doc_id", "chunk_ix", "chunked_text")
    waves = [docs, cut.where("doc_id % 7 <> 0"), cut.where("doc_id % 7 <> 0 or doc_id = 7")]
    index, before = shared_dir(spark, "index"), None
    embedder = rag.fit_embedder(chunked(docs), "chunked_text", 64)
    for number, wave in enumerate(waves):
        after = materialise(chunked(wave), "wave")
        rows = index_sync.sync_changes(spark, before, after, index, number, embedder)
        before = after
    texts = F.transform(F.array_sort(F.collect_list(F.struct("chunk_ix", "chunked_text"))), lambda c: c["chunked_text"])
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("chunks"),
        F.count_if(F.size("embedding") == 64).alias("embedded"),
        F.md5(F.array_join(texts, "|")).alias("text_hash"),
    )


def routed_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Write events by type and day, write one part again, and read all back."""
    events = table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("lob"), F.to_date("ts").alias("run_date"), F.lit("A").alias("feed")
    )
    out = shared_dir(spark, "routed")
    sinks.write_routed(events, out)
    sinks.write_routed(events.where("lob = 'view'"), out)
    return spark.read.parquet(out).groupBy("lob", "run_date", "feed").agg(F.count(F.lit(1)).alias("n"))


def append_aligned(spark: SparkSession, folder: str) -> DataFrame:
    """A table created by one batch; the next batch has an odd, a missing and an extra column."""
    out = shared_dir(spark, "audit")
    first = table(spark, folder, "supplier").selectExpr("s_suppkey id", "s_name `full name`", "s_acctbal bal")
    second = table(spark, folder, "customer").selectExpr("cast(c_acctbal as string) bal", "c_custkey id", "c_mktsegment extra")
    sinks.append_aligned(first, out)
    sinks.append_aligned(second, out)
    return spark.read.parquet(out)


def _write_zips(entries: DataFrame, folder: str) -> None:
    """Zip rows (archive, entry, body) from the tasks, one file per archive name and partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, inside = archives.locate(folder)
        store.create_dir(inside, recursive=True)
        written = 0
        for number, batch in enumerate(batches):
            for (name, part), rows in batch.groupby(["archive", "part"]):
                with store.open_output_stream(f"{inside}/{name}-{part:05d}-{number}.zip") as sink:
                    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
                        for entry, body in zip(rows["entry"], rows["body"]):
                            archive.writestr(entry, body)
                written += len(rows)
        yield pd.DataFrame({"written": [written]})

    located = entries.select("archive", "entry", "body", F.spark_partition_id().alias("part"))
    located.mapInPandas(run, "written long").agg(F.sum("written")).collect()


def _zipped_chat(spark: SparkSession, folder: str) -> str:
    """Conversations zipped by the tasks into the shared folder, one entry per message."""
    out = shared_dir(spark, "archives")
    chat = table(spark, folder, "conversations")
    _write_zips(
        chat.select(
            F.concat(F.lit("feed_"), F.pmod(F.xxhash64("conv_id"), F.lit(8)).cast("string")).alias("archive"),
            F.concat_ws("/", "conv_id", F.concat(F.col("turn").cast("string"), F.lit(".json"))).alias("entry"),
            F.to_json(F.struct("role", "text")).alias("body"),
        ),
        out,
    )
    return out


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    out = _zipped_chat(spark, folder)
    return _messages(archives.read_archives(archives.list_archives(spark, out, "feed_")))


def load_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the data source."""
    archive_source.register(spark)
    return _messages(spark.read.format("archives").option("contains", "feed_").load(_zipped_chat(spark, folder)))


def _messages(entries: DataFrame) -> DataFrame:
    parts = F.split("entry", "/")
    return entries.select(
        parts[0].cast("long").alias("conv_id"),
        F.regexp_extract(parts[1], r"\d+", 0).cast("long").alias("turn"),
        F.from_json("body", "role string, text string").alias("m"),
        "error",
    ).select("conv_id", "turn", "m.role", "m.text", "error")


def work_list(spark: SparkSession, folder: str) -> DataFrame:
    """Labels written as JSON files, listed without reading them."""
    out = shared_dir(spark, "to_process")
    table(spark, folder, "labels").repartition(4, "doc_id").write.json(out)
    listed = documents.work_list(spark, out, "2001-08-01")
    return listed.groupBy("start_date", "retry_count", F.endswith("transcript_name", F.lit(".json")).alias("is_json")).agg(
        (F.count(F.lit(1)) > 0).alias("found")
    )


def lookup_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Skill and queue sheets written as csv from suppliers and customers, read back into one lookup."""
    out = shared_dir(spark, "sheets")
    supplier, customer = table(spark, folder, "supplier"), table(spark, folder, "customer")
    skills = supplier.selectExpr("concat(' ', s_suppkey, '.0') Skill", "s_nationkey % 2 part")
    skills.where("part = 0").select("Skill").write.option("header", True).csv(f"{out}/ma")
    skills.where("part = 1").select("Skill").write.option("header", True).csv(f"{out}/medical")
    customer.selectExpr("concat('Q', c_custkey) Queue_Name").write.option("header", True).csv(f"{out}/queues")
    sheets = {lob: lookups.read_sheet(spark, f"{out}/{name}") for lob, name in (("MA", "ma"), ("MediCal", "medical"))}
    found = lookups.skill_lookup(sheets)
    return found.unionByName(lookups.queue_lookup(lookups.read_sheet(spark, f"{out}/queues"), found))


def read_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Customer names written as text files, read as whole documents, and their lines."""
    out = shared_dir(spark, "texts")
    table(spark, folder, "customer").select("c_name").repartition(6, "c_name").write.text(out)
    lines = rag.read_docs(spark, out).select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.where("line <> ''")


def _score(name: int, text: str) -> str:
    if not text.isascii():
        raise ValueError(f"message {name} is not ascii")
    return f"/out/{name}_{len(text.split())}.json"


def apply_scorer(spark: SparkSession, folder: str) -> DataFrame:
    """A small scorer that counts words and refuses some messages."""
    chat = table(spark, folder, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    return score.unpack(score.apply_scorer(chat, _score, "id", "text", "2001-08-01")).drop("text")


def stage_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two timed stages written to csv, read back and merged into a log row per segment."""
    log = audit.StageLog(spark)
    customers = table(spark, folder, "customer")
    log.run("NLP Processing", customers.count)
    log.run("Additional data points processing", customers.distinct().count)
    out = shared_dir(spark, "stages")
    log.write(out)
    stages = {"NLP Processing": "nlp", "Additional data points processing": "data_points"}
    times = audit.stage_times(audit.read_stage_log(spark, out), stages)
    found = one_row(times)
    source = customers.select(F.col("c_mktsegment").alias("lob")).distinct().withColumns(
        {c: found[c] for c in times.columns}
    )
    target = sinks.ensure_columns(
        customers.groupBy(F.col("c_mktsegment").alias("lob")).agg(F.count(F.lit(1)).alias("n")),
        {c: "string" for c in times.columns},
    )
    merged = merge.upsert(target, source, "lob")
    return merged.select("lob", "n", *[F.col(c).isNotNull().alias(f"has_{c}") for c in times.columns])


QUERIES = {
    "upsert_matched": upsert_matched,
    "upsert_insert": upsert_insert,
    "upsert_large": upsert_large,
    "merge_parts": merge_parts,
    "stream_changes": stream_changes,
    "update_log": update_log,
    "change_feed": change_feed,
    "unprocessed": unprocessed,
    "lagged_folder": lagged_folder,
    "stream_new": stream_new,
    "sync_index": sync_index,
    "sync_changes": sync_changes,
    "routed_sink": routed_sink,
    "append_aligned": append_aligned,
    "read_archives": read_archives,
    "load_archives": load_archives,
    "lookup_sheets": lookup_sheets,
    "read_docs": read_docs,
    "work_list": work_list,
    "apply_scorer": apply_scorer,
    "stage_log": stage_log,
}

ORACLE = {
    "upsert_matched": with_ctes(
        """SELECT t.k, CASE WHEN s.k IS NOT NULL AND t.seg = 'BUILDING' THEN s.bal ELSE t.bal END AS bal, t.seg
FROM target t LEFT JOIN source s ON s.k = t.k""",
        target=TARGET,
        source=SOURCE,
    ),
    "upsert_insert": with_ctes(
        """SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.in_s THEN s.bal ELSE t.bal END AS bal, CASE WHEN s.in_s THEN s.seg ELSE t.seg END AS seg
FROM (SELECT *, TRUE AS in_t FROM target) t FULL JOIN (SELECT *, TRUE AS in_s FROM source) s ON s.k = t.k""",
        target=TARGET,
        source=SOURCE,
    ),
    "upsert_large": with_ctes(
        """SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.in_s THEN s.bal ELSE t.bal END AS bal, CASE WHEN s.in_s THEN s.seg ELSE t.seg END AS seg
FROM (SELECT *, TRUE AS in_t FROM target) t FULL JOIN (SELECT *, TRUE AS in_s FROM source) s ON s.k = t.k""",
        target=TARGET,
        source=SOURCE,
    ),
    "merge_parts": with_ctes(
        """SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.in_s THEN s.bal ELSE t.bal END AS bal, CASE WHEN s.in_s THEN s.seg ELSE t.seg END AS seg,
       TRUE AS few
FROM (SELECT *, TRUE AS in_t FROM target) t FULL JOIN (SELECT *, TRUE AS in_s FROM source WHERE k % 50 = 7 AND k < 500) s ON s.k = t.k""",
        target=TARGET,
        source=SOURCE,
    ),
    "stream_changes": with_ctes(
        """SELECT doc_id, count(*) AS chunks, sum(CAST(n AS DOUBLE)) AS words, md5(string_agg(chunk, '|' ORDER BY ix)) AS text_hash
FROM (SELECT doc_id, ix, len(list_slice(tok, ix * 96 + 1, ix * 96 + 128)) AS n, array_to_string(list_slice(tok, ix * 96 + 1, ix * 96 + 128), ' ') AS chunk FROM windows) c
GROUP BY doc_id""",
        words="SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS tok FROM documents WHERE doc_id % 7 <> 0 OR doc_id = 7",
        tokens="SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN tok[1:100] ELSE tok END AS tok FROM words",
        windows="SELECT doc_id, tok, unnest(range(0, 1 + CAST(greatest(0, ceil((len(tok) - 128) / 96.0)) AS BIGINT))) AS ix FROM tokens WHERE len(tok) > 0",
    ),
    "update_log": with_ctes(
        """SELECT d.lob, d.run_date, d.feed, d.total_transcript_count,
       CASE WHEN d.lob = 'Core Premier' AND c.run_date IS NOT NULL THEN CAST(CASE d.feed WHEN 'S' THEN c.s ELSE c.o END AS VARCHAR) END AS llm_processed_transcript_count,
       CASE WHEN d.lob = 'Core Premier' THEN '12:00' END AS nlp_end
FROM daily d LEFT JOIN (SELECT processed_date AS run_date, count(DISTINCT id) FILTER (org_id = 'S') AS s, count(DISTINCT id) FILTER (org_id <> 'S') AS o
  FROM processed WHERE org_id IS NOT NULL GROUP BY 1) c USING (run_date)""",
        daily=DAILY,
        processed=PROCESSED,
    ),
    "change_feed": with_ctes(
        """SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
       CASE WHEN b.c_custkey IS NULL THEN 'insert' WHEN a.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS change_type,
       CASE WHEN a.c_custkey IS NULL THEN b.c_acctbal ELSE a.c_acctbal END AS c_acctbal,
       CASE WHEN a.c_custkey IS NULL THEN b.c_mktsegment ELSE a.c_mktsegment END AS c_mktsegment
FROM customer b FULL JOIN after_rows a ON a.c_custkey = b.c_custkey
WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL OR a.c_acctbal IS DISTINCT FROM b.c_acctbal
   OR a.c_mktsegment IS DISTINCT FROM b.c_mktsegment""",
        after_rows=AFTER,
    ),
    "unprocessed": "SELECT c_custkey AS name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
    "lagged_folder": """SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) - CASE event_type WHEN 'view' THEN 4 WHEN 'click' THEN 5 ELSE 3 END""",
    "stream_new": "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
    "sync_index": with_ctes(
        """SELECT doc_id, CAST(1 + greatest(0, ceil((n - 128) / 96.0)) AS BIGINT) AS chunks FROM t WHERE n > 0""",
        t="SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n FROM documents",
    ),
    "sync_changes": with_ctes(
        """SELECT doc_id, count(*) AS chunks, count(*) AS embedded, md5(string_agg(chunk, '|' ORDER BY ix)) AS text_hash
FROM (SELECT doc_id, ix, array_to_string(list_slice(tok, ix * 96 + 1, ix * 96 + 128), ' ') AS chunk FROM windows) c GROUP BY doc_id""",
        words="SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS tok FROM documents WHERE doc_id % 7 <> 0 OR doc_id = 7",
        tokens="SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN tok[1:100] ELSE tok END AS tok FROM words",
        windows="SELECT doc_id, tok, unnest(range(0, 1 + CAST(greatest(0, ceil((len(tok) - 128) / 96.0)) AS BIGINT))) AS ix FROM tokens WHERE len(tok) > 0",
    ),
    "routed_sink": "SELECT event_type AS lob, CAST(ts AS DATE) AS run_date, 'A' AS feed, count(*) AS n FROM events GROUP BY 1, 2",
    "append_aligned": """SELECT s_suppkey AS id, s_name AS full_name, s_acctbal AS bal FROM supplier
UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer""",
    "load_archives": "SELECT conv_id, turn, role, text, CAST(NULL AS VARCHAR) AS error FROM conversations",
    "read_archives": "SELECT conv_id, turn, role, text, CAST(NULL AS VARCHAR) AS error FROM conversations",
    "lookup_sheets": """SELECT CASE WHEN s_nationkey % 2 = 0 THEN 1 ELSE 2 END AS ord, CASE WHEN s_nationkey % 2 = 0 THEN 'MA' ELSE 'MediCal' END AS lob,
       'skill' AS kind, '106' || CAST(s_suppkey AS VARCHAR) AS key FROM supplier
UNION ALL SELECT 2, 'MediCal', 'queue', 'Q' || CAST(c_custkey AS VARCHAR) FROM customer""",
    "read_docs": "SELECT c_name AS line FROM customer",
    "work_list": "SELECT '2001-08-01' AS start_date, 1 AS retry_count, TRUE AS is_json, count(*) > 0 AS found FROM labels",
    "apply_scorer": """SELECT id, CASE WHEN ok THEN 'Success' ELSE 'Failed' END AS status,
       CASE WHEN NOT ok THEN 'message ' || id || ' is not ascii' END AS error_message, '2001-08-01' AS processed_date,
       CASE WHEN ok THEN '/out/' || id || '_' || len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) || '.json' END AS output_file_path
FROM (SELECT conv_id * 1000 + turn AS id, text, octet_length(encode(text)) = length(text) AS ok FROM conversations) c""",
    "stage_log": """SELECT c_mktsegment AS lob, count(*) AS n, TRUE AS has_nlp_start_time, TRUE AS has_nlp_end_time,
       TRUE AS has_data_points_start_time, TRUE AS has_data_points_end_time FROM customer GROUP BY 1""",
}
