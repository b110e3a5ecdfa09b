"""The four jobs end to end, composed from the operators.

Every input, path and date is an argument.  A stage used more than once is written once and read back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from engage.operators import audit, enrich, evaluate, labels, merge, model, prep, rag, route, score
from engage.session import materialise
from engage.sources import archives, documents, sinks

# Takes gated calls with their finance LOB, returns decisions.
Rule = Callable[[DataFrame], DataFrame]


def route_feed(
    bodies: DataFrame,
    members: DataFrame,
    rule: Rule,
    source: str,
    run_date: str,
    audit_path: str,
    routed_path: str,
    drop_empty: bool = False,
    errors_path: str | None = None,
    log_path: str | None = None,
    started: str | None = None,
    ended: str | None = None,
) -> DataFrame:
    """Route one feed's documents (path, body, and error where an archive could not be read); the day's log returned.

    Written are audit rows with all metadata the record has no column of its own for, selected documents whole,
    documents and archives that could not be read with the error, and the log with its counts as text.  Each
    table is laid out by run date and feed, and a rerun replaces that part.  Documents are read and parsed once.
    """
    whole = bodies.withColumn("document", F.col("body"))
    earlier = F.col("error") if "error" in bodies.columns else F.lit(None).cast("string")
    whole = whole.withColumn("_earlier", earlier)
    parsed = documents.parse_documents(whole, "body", "path")
    parsed = parsed.withColumn("error", F.coalesce("_earlier", "error")).drop("_earlier")
    parsed = materialise(route.gate(route.codes(parsed, drop_empty=False)), "parsed")
    day = {"run_date": F.to_date(F.lit(run_date)), "feed": F.lit(source)}
    if errors_path:
        failed = documents.unreadable(parsed).withColumns(day)
        sinks.replace_parts(failed, errors_path, tuple(day))
    calls = documents.readable(parsed)
    if drop_empty:
        calls = calls.where("has_metadata")
    calls = calls.drop("has_metadata")
    lobs = enrich.latest_lob(members, enrich.member_keys(calls))
    decided = materialise(rule(enrich.with_finance_lob(calls, lobs)), "decided")
    audited = route.audit_rows(decided, source, run_date)
    sinks.replace_parts(audited, audit_path, ("run_date", "source"))
    selected = decided.where("selected").select(
        "lob", *[c.alias(n) for n, c in day.items()], "path", "document", "channels", "language", "mediaId", "status",
        "dateCreated", "contentType", "other_metadata",
    )
    sinks.write_routed(selected, routed_path)
    log = audit.daily_log(audited, by=("selected_lob", "run_date", "source"), started=started, ended=ended)
    if log_path:
        sinks.replace_parts(audit.as_text_counts(log), log_path, ("run_date", "source"))
    return log


def route_archives(
    spark: SparkSession, folder: str, prefix: str, members: DataFrame, rule: Rule, source: str, run_date: str, **paths: object
) -> DataFrame:
    """``route_feed`` over the documents in a folder's archives; entries and archives that cannot be read are errors."""
    entries = archives.read_archives(archives.list_archives(spark, folder, prefix))
    bodies = entries.select(F.concat_ws("/", "archive", "entry").alias("path"), "body", "error")
    return route_feed(bodies, members, rule, source, run_date, **paths)


def feature_table(
    members: DataFrame,
    cycles: Sequence[labels.Cycle],
    by_member: Sequence[DataFrame] = (),
    by_zip: Sequence[DataFrame] = (),
    providers: Sequence[DataFrame] = (),
    lob_pattern: str = "%IFP%",
    drop_empty: bool = False,
) -> DataFrame:
    """Labelled member rows joined with member, area and provider facts, cleaned and filled.

    The fill leaves an all-NULL numeric column as a constant; ``drop_empty`` drops such columns before it.

    Facts key on ``member_id``, ``zipcode`` and ``facets_prov_id``; members carry ``zipcode`` and ``prov_ipa_id``.
    """
    rows = labels.survival(members, cycles, lob_pattern)
    for facts in by_member:
        rows = enrich.join_dim(rows, facts, "member_id")
    for facts in by_zip:
        rows = enrich.join_dim(rows, facts, "zipcode")
    matched = F.lit(0)
    if providers:
        rows = enrich.join_dim(
            rows, enrich.union_tables(*providers), "prov_ipa_id", "facets_prov_id", matched="_found"
        )
        matched = F.col("_found")
    rows = labels.provider_flags(rows, "prov_ipa_id", matched).drop("_found")
    clean = prep.decimals_to_double(prep.drop_duplicate_columns(rows))
    if drop_empty:
        clean = prep.drop_empty_columns(materialise(clean, "joined"))
    return prep.fill_constant(clean)


def trim_and_derive(features: DataFrame) -> DataFrame:
    """Distance to the provider and tenure, each trimmed at its 1st and 95th percentile, the distance twice."""
    rows = materialise(prep.distance_feature(features), "distance")
    for _ in range(2):
        rows = prep.trim_quantiles(rows, "pcp_distance")
    return prep.trim_quantiles(materialise(prep.tenure(rows), "tenure"), "tenure")


def train_and_backtest(
    table: DataFrame,
    features: Sequence[str],
    key: str,
    cycle: str,
    train_cycle: object,
    label: str = "churn_flag",
    trials: int = 0,
    rounds: tuple[int, int] = (500, 1000),
    folds: int = 0,
    **params: object,
) -> tuple[PipelineModel, dict[str, DataFrame]]:
    """Search, fit on the training cycle, keep the best 30 features, evaluate on held-out rows and other cycles.

    ``trials`` parameter sets of ``rounds`` boosting rounds are compared on a validation share of the training rows (0: the
    given parameters stand); the fit weighs the classes and stops early on a share of its own; ``folds`` > 0 adds
    the mean AUC over so many folds.  Columns that name geography or providers are left out.
    """
    usable = set(prep.drop_matching(table.select(*features)).columns)
    features = [f for f in features if f in usable]
    current, others = model.split_cycles(table, cycle, train_cycle)
    split = materialise(model.stratified_split(current, key, label), "split")
    train, test = split.where("is_test = 0"), split.where("is_test = 1")
    reports = {}
    if trials:
        reports["trials"] = model.tune(train, features, label, trials, rounds)[1]
        params = {**params, **model.best_params(reports["trials"])}
    ranking = model.importance(model.train(train, features, label, weighted=False, **params), train, features)
    best = [r["feature"] for r in model.top_features(ranking).collect()]
    fitted = model.train(train, best, label, validate_by=key, **params)
    if folds:
        mean = model.cross_validate(train, best, label, key, folds, **params)
        reports["folds"] = table.sparkSession.createDataFrame([(mean,)], "mean_auc double")
    holdout = materialise(model.score(fitted, test).select(key, label, "p"), "holdout")
    earlier = materialise(model.score(fitted, others).select(key, cycle, label, "p"), "backtest")
    reports |= {"importance": ranking, "tiers": model.tier_counts(model.risk_tier(earlier))}
    for name, rows, threshold in (("holdout", holdout, 0.5), ("backtest", earlier, 0.8)):
        reports[f"{name}_auc"] = evaluate.auc(rows, label)
        reports[f"{name}_ks"] = evaluate.ks(rows, label)
        reports[f"{name}_confusion"] = evaluate.confusion(rows, threshold, label)
        reports[f"{name}_report"] = evaluate.report(rows, threshold, label)
        reports[f"{name}_lift"] = evaluate.lift_table(rows, label)
    return fitted, reports


def answer_prompts(
    chat: DataFrame,
    index: DataFrame,
    embedder: PipelineModel | Callable,
    rewriter: Callable[[DataFrame], DataFrame] | None = None,
    k: int = 3,
    digits: int = 12,
) -> DataFrame:
    """Prompts for a batch of conversations over an index of embedded chunks.

    ``rewriter`` turns the messages of ``rag.rewrite_prompt`` into (conv_id, question), one per conversation, or the job
    fails; without one the last message is asked.
    """
    asked = rewriter(rag.rewrite_prompt(chat)) if rewriter else rag.split_chat(chat)
    # written once: a rewriter or embedder may be a paid call, or answer differently next time
    message = F.concat(F.lit("more than one question for conversation "), F.col("query_id").cast("string"))
    once = F.when(F.col("n") > 1, F.raise_error(message).cast("string")).otherwise(F.col("question"))
    asked = asked.groupBy(F.col("conv_id").alias("query_id")).agg(
        F.any_value("question").alias("question"), F.count(F.lit(1)).alias("n")
    ).select("query_id", once.alias("question"))
    questions = materialise(rag.embed(asked, "question", embedder), "questions")
    hits = rag.top_k(questions, index, k, digits=digits)
    return rag.prompt(chat, rag.context(hits, index))


def score_and_enrich(
    work: DataFrame,
    scorer: score.Scorer,
    result_schema: str,
    sources: Sequence[tuple[DataFrame | None, str, Mapping[str, object]]],
    blanks: Mapping[str, object],
    run_date: str,
    table_path: str,
    log: audit.StageLog,
) -> DataFrame:
    """Score documents (key, text), flatten the JSON results, add optional facts in order and append to a table.

    ``sources`` is a chain of (frame or None when switched off, key, defaults).  Returns the scored status rows.
    """
    key, text = work.columns[:2]
    scored = log.run(
        "NLP Processing",
        lambda: materialise(score.unpack(score.apply_scorer(work, scorer, key, text, run_date)).drop(text), "scored"),
    )

    def enrich_all() -> None:
        good = scored.where("status = 'Success'").select(key, "processed_date", "output_file_path")
        rows = enrich.flatten_json(good, "output_file_path", result_schema, prefix=False)
        for source, on, defaults in sources:
            rows = enrich.optional(rows, source, on, defaults)
        sinks.append_aligned(prep.fill_blank(rows, blanks), table_path)

    log.run("Additional data points processing", enrich_all)
    return scored


def update_log(daily: DataFrame, keys: Sequence[str], counts: DataFrame, times: DataFrame) -> DataFrame:
    """The daily log with processed counts on the rows they belong to, and stage times on the rows named by ``times``.

    Counts only update; times also insert rows that the log lacks.
    """
    columns = {c: "string" for c in (*counts.columns, *times.columns) if c not in keys}
    wide = sinks.ensure_columns(daily, columns)
    counted = merge.upsert(wide, counts, keys, insert=False)
    return merge.upsert(counted, times, keys)
