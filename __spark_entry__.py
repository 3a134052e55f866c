"""

Roles of the given tables: `pages` are the articles with URLs, `documents` the approvals (the
first line is the headline), `embeddings` the vectors; ids of all of them name articles.
Every query works on whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echowire.functions.urls import domain_of, with_canonical_url
from echowire.operators import date_proximity, features, implied, near_texts, ratings, state_overlap
from echowire.operators.figures import one_row
from echowire.operators.pivot_search import high_report, pivot_pairs
from echowire.operators.similarity import similar_pairs, similarity_progress, similarity_report
from echowire.operators.skew import attach
from echowire.plans import ledger, passes, reports, runs
from echowire.session import scratch_path, stored
from echowire.sources import id_files, snapshots, tables
from echowire.sources.intake_log import LOG, load_rows, roster

try:  # the corpus operators are optional: without them the other queries work alike
    import corpus_pipeline
    from echowire.llm import registry as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "echowire.llm"):
        raise
    corpus_pipeline = corpus = None

RUN_TS = datetime(2024, 1, 1, tzinfo=timezone.utc)
WEIGHTS = {"urlCheck": 3.0, "contentHash": 2.0, "embeddingSearch": 1.0}
LATER_TS = datetime(2024, 2, 1, tzinfo=timezone.utc)
THRESHOLD = 0.3  # the given vectors are far apart; the default 0.8 would select copies only

# ---------------------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "pages").select(F.col("page_id").alias("id"), "url")


def _approved(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("articleId"),
        F.substring_index("text", "\n", 1).alias("headline"),
        "text",
    )


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    """Approvals with several rows per article: the turns of a conversation."""
    return _table(spark, sf, "conversations").select(
        F.col("turn").alias("id"), F.col("conv_id").alias("articleId"), F.col("role").alias("headline"), "text"
    )


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings").select(F.col("vec_id").alias("articleId"), "embedding")


def _ids(spark: SparkSession, sf: str, name: str, column: str) -> DataFrame:
    return _table(spark, sf, name).select(F.col(column).alias("articleId"))


def _id_lines(spark: SparkSession, sf: str) -> DataFrame:
    """An id file with good, repeated, padded, blank and malformed lines, written and read back."""
    lines = (
        _table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias(" articleId "))
        .union(_table(spark, sf, "conversations").select(F.format_string(" +%d ", "conv_id")))
        .union(_table(spark, sf, "documents").select("source"))
        .union(_table(spark, sf, "events").select(F.format_string("%d.0", "event_id")))
        .union(_table(spark, sf, "orders").select(F.format_string("%d", "o_custkey")))
    )
    path = scratch_path(spark, "id-file")
    lines.withColumn("note", F.lit("a, b")).write.csv(path, header=True)
    return id_files.read_id_file(spark, path)


def _log(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Log after a first load, rows a second load adds, approved ids at the second load."""
    empty = spark.createDataFrame([], LOG)
    first = load_rows(
        empty, _ids(spark, sf, "embeddings", "vec_id"), _ids(spark, sf, "pages", "page_id"), 1
    )
    approved = _ids(spark, sf, "documents", "doc_id")
    return first, load_rows(first, _ids(spark, sf, "labels", "doc_id"), approved, 2), approved


def _roster(spark: SparkSession, sf: str) -> DataFrame:
    first, second, _ = _log(spark, sf)
    return passes.stored(roster(first.unionByName(second)), "roster")


def _everyone(ids: DataFrame) -> DataFrame:
    """A roster on which every article is both new and approved."""
    return ids.select("articleId", F.lit(1).alias("newLoad"), F.lit(1).alias("approvedLoad"))


def _with_first(rows: DataFrame, group: str) -> DataFrame:
    """Pairs of each article with the lowest other article of its group."""
    firsts = rows.groupBy(group).agg(
        F.min("articleId").alias("articleIdApproved"), F.count("*").alias("n")
    )
    pairs = attach(rows, firsts, [group], ["articleId"], size="n").select(
        F.col("articleId").alias("articleIdNew"), "articleIdApproved"
    )
    return pairs.where("articleIdNew <> articleIdApproved")


def _with_firsts(*groups: tuple[DataFrame, str]) -> DataFrame:
    """Pairs as above for several tables and groups, found in one join."""
    rows = [
        table.select("articleId", F.concat(F.lit(f"{i}:"), F.col(group).cast("string")).alias("group"))
        for i, (table, group) in enumerate(groups)
    ]
    return _with_first(reduce(DataFrame.unionByName, rows), "group")


def _sources(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    return _table(spark, sf, "documents").select(F.col("doc_id").alias("articleId"), "source"), "source"


def _others(spark: SparkSession, sf: str, keys: DataFrame) -> list[tuple[DataFrame, str]]:
    """Articles by content key, canonical URL, host, and label of their vector."""
    urls = with_canonical_url(_articles(spark, sf)).select(
        F.col("id").alias("articleId"), "canonicalUrl", domain_of("canonicalUrl").alias("host"))
    labels = _table(spark, sf, "embeddings").select(F.col("vec_id").alias("articleId"), "label")
    return [(keys, "key"), (urls, "canonicalUrl"), (urls, "host"), (labels, "label")]


def _source_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _with_first(*_sources(spark, sf))


def _copy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _with_first(_features(spark, sf, "contentHash"), "key")


def _part_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each part with the first of its brand."""
    return _with_first(_table(spark, sf, "part").select(F.col("p_partkey").alias("articleId"), "p_brand"), "p_brand")


def _part_states(spark: SparkSession, sf: str) -> DataFrame:
    """Parts stand for articles and the suppliers that ship them for states; written once because two joins read it."""
    shipped = _table(spark, sf, "lineitem").select(F.col("l_partkey").alias("articleId"), F.col("l_suppkey").alias("stateId"))
    return stored(state_overlap.state_bitmaps(shipped), "states")


def _order_days(spark: SparkSession, sf: str) -> DataFrame:
    """Orders stand for articles with a date."""
    dated = _table(spark, sf, "orders").select(F.col("o_orderkey").alias("articleId"), F.col("o_orderdate").alias("date"))
    return stored(date_proximity.day_features(dated), "days")


def _order_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each order with the first of its customer."""
    return _with_first(_table(spark, sf, "orders").select(F.col("o_orderkey").alias("articleId"), "o_custkey"), "o_custkey")


def _loaded(spark: SparkSession, sf: str) -> DataFrame:
    """Unscored ratings of each article with the first of its source, copies, URL, host and label."""
    pairs = ratings.insert_or_ignore(tables.empty_ratings(spark), _source_pairs(spark, sf), RUN_TS)
    more = _with_firsts(*_others(spark, sf, _features(spark, sf, "contentHash")))
    return ratings.insert_or_ignore(pairs, more, RUN_TS)


def _features(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    """The feature table of a metric, written once because several joins read it."""
    if metric == "urlCheck":
        return passes.stored(features.url_features(_articles(spark, sf)), "url-features")
    if metric == "contentHash":
        return passes.stored(features.content_features(_approved(spark, sf)), "content-features")
    return features.vector_features(_vectors(spark, sf))


def _stored(spark: SparkSession, sf: str, keys: DataFrame | None = None) -> DataFrame:
    """The same ratings, loaded at once, as a snapshot, which is what a pass reads."""
    keys = _features(spark, sf, "contentHash") if keys is None else keys
    pairs = _with_firsts(_sources(spark, sf), *_others(spark, sf, keys))
    return passes.load_pairs(
        tables.empty_ratings(spark), pairs, scratch_path(spark, "ratings"), RUN_TS
    )


def _passed(spark: SparkSession, sf: str, *metrics: str, limit: int | None = None) -> DataFrame:
    """The snapshot after a pass over each of the metrics."""
    keys = _features(spark, sf, "contentHash")
    snapshot = _stored(spark, sf, keys)
    for metric in metrics:
        made = keys if metric == "contentHash" else _features(spark, sf, metric)
        out = scratch_path(spark, "ratings")
        snapshot = passes.metric_pass(
            ratings.rating_rows(snapshot), metric, made, out, RUN_TS, limit=limit
        )
    return snapshot


def _bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings loaded in two steps and filled, each a bucketed snapshot."""
    made = {metric: _features(spark, sf, metric) for metric in tables.METRICS}
    pairs = ratings.insert_or_ignore(tables.empty_ratings(spark), _source_pairs(spark, sf), RUN_TS)
    first = snapshots.write_bucketed(snapshots.bucketed(pairs, 8), scratch_path(spark, "bucketed"), 8)
    more = _with_firsts(*_others(spark, sf, made["contentHash"]))
    whole = passes.bucketed_load(first, more, scratch_path(spark, "bucketed"), RUN_TS, 8)
    return passes.bucketed_fill(whole, made, scratch_path(spark, "bucketed"), RUN_TS, 8)


def _limited(spark: SparkSession, sf: str) -> DataFrame:
    """Scores after a pass over at most 100 pairs."""
    return _cells(_passed(spark, sf, "contentHash", limit=100), "contentHash")


def _filled(spark: SparkSession, sf: str) -> DataFrame:
    """A pass over ratings of which every other new article has a score; what it touched bears its stamp."""
    half = F.when(F.col("articleIdNew") % 2 == 0, F.lit(0.5))
    some = _stored(spark, sf).withColumn("contentHash", half)
    done = passes.content_pass(some, _approved(spark, sf), scratch_path(spark, "ratings"), LATER_TS)
    return done.select(*tables.PAIR, "contentHash", (F.col("updatedAt") == F.lit(LATER_TS)).alias("touched"))


def _failing_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The given vectors, some of them missing and some cut short."""
    part = F.col("articleId") % 5
    return _vectors(spark, sf).withColumn(
        "embedding", F.when(part == 1, F.slice("embedding", 1, 8)).when(part != 0, F.col("embedding")))


def _failed(spark: SparkSession, sf: str) -> DataFrame:
    return passes.embedding_pass(
        _stored(spark, sf), _failing_vectors(spark, sf), scratch_path(spark, "ratings"), RUN_TS)


def _scored(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    return _passed(spark, sf, metric)


def _all_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings after one pass over all three metrics."""
    made = {metric: _features(spark, sf, metric) for metric in tables.METRICS}
    snapshot = _stored(spark, sf, made["contentHash"])
    return passes.fill_pass(snapshot, made, scratch_path(spark, "ratings"), RUN_TS)


def _cells(rows: DataFrame, *metrics: str) -> DataFrame:
    return rows.select(*tables.PAIR, *(F.round(m, 6).alias(m) for m in metrics))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def _whole_numbers(df: DataFrame) -> DataFrame:
    """Pair counts as BIGINT, which is wide enough for the given tables."""
    return df.select(*(
        F.col(name).cast("bigint").alias(name) if kind.startswith("decimal") else F.col(name)
        for name, kind in df.dtypes
    ))


def _letter_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors from a stand-in for a text encoder: how often each of the letters a to z occurs."""

    def load_encoder():
        def encode(texts: list[str]) -> np.ndarray:
            return np.array([[t.count(chr(97 + i)) for i in range(26)] for t in texts], dtype=np.float32)

        return encode

    vectors = features.encode_articles(_approved(spark, sf), load_encoder, 26)
    return vectors.select(
        "articleId", *(F.col("embedding")[i].cast("bigint").alias(chr(97 + i)) for i in range(26))
    )


# --------------------------------------------------------------------------- queries


def _sample(spark: SparkSession, sf: str) -> DataFrame:
    return reports.best_scored_urls(_scored(spark, sf, "urlCheck"), _articles(spark, sf), 10)


def _recomputed(spark: SparkSession, sf: str) -> DataFrame:
    """All scores after a first pass over some pairs and a recomputing pass over all."""
    some = ratings.rating_rows(_passed(spark, sf, "contentHash", limit=100))
    again = passes.content_pass(
        some, _approved(spark, sf), scratch_path(spark, "ratings"), RUN_TS, recompute=True
    )
    return _cells(again, "contentHash")


def _run_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records of a loading and a content run, appended to a table and read back."""
    path = scratch_path(spark, "runs")
    pairs, scored = _source_pairs(spark, sf), _scored(spark, sf, "contentHash")
    runs.append_run(runs.run_record("load", pairs, reports.pair_stats(_loaded(spark, sf)), RUN_TS), path)
    runs.append_run(runs.run_record(
        "content", scored.select(*tables.PAIR), reports.content_run_result(scored), RUN_TS), path)
    return runs.read_runs(spark, path).select(
        "operation", "inputRows", "inputHash", F.col("counts")["total_pairs"].alias("total_pairs"),
        F.col("counts")["processed"].alias("processed"), F.col("counts")["matches"].alias("matches"))


def _cleared(spark: SparkSession, sf: str) -> DataFrame:
    """Rows touched by emptying each metric, and what is left after emptying the URL scores."""
    stored = _all_scored(spark, sf)
    counts = [
        ratings.cleared_count(stored, metric).withColumnRenamed("cleared", f"cleared_{metric}")
        for metric in tables.METRICS
    ]
    left = ratings.clear_metric(stored, "urlCheck", RUN_TS).agg(
        *(F.count(metric).alias(f"left_{metric}") for metric in tables.METRICS)
    )
    return one_row(*counts, left)


def _implied_similarity(spark: SparkSession, sf: str) -> DataFrame:
    ros = _roster(spark, sf)
    report = similarity_progress(ros, similarity_report(ros, _vectors(spark, sf), THRESHOLD))
    return _rounded(_whole_numbers(report), "avg_similarity_score", "overall_avg_similarity")


def _ledger_status(spark: SparkSession, sf: str) -> DataFrame:
    """Status from the entries that two loads, a fill, an emptied column and a second fill have made."""
    book = scratch_path(spark, "ledger")
    made = {metric: _features(spark, sf, metric) for metric in tables.METRICS}
    values = stored(ratings.article_values(made), "article-values")
    held = tables.empty_ratings(spark)
    more = _with_firsts(*_others(spark, sf, made["contentHash"]))
    for step, pairs in enumerate((_source_pairs(spark, sf), more)):
        fresh = stored(ratings.new_ratings(held, pairs, RUN_TS), "fresh")
        ledger.enter_insert(fresh, book, step, THRESHOLD)
        held = held.unionByName(fresh)
    ledger.enter_fill(stored(ratings.pending_scores(held, values), "scores"), book, 2, THRESHOLD)
    held = stored(ratings.fill_pending(held, values, RUN_TS), "held")
    ledger.enter_clear(spark, "contentHash", book, 3, THRESHOLD)
    held = ratings.clear_metric(held, "contentHash", RUN_TS)
    again = ratings.pending_scores(held, values.select("articleId", "contentHash"))
    ledger.enter_fill(stored(again, "scores"), book, 4, THRESHOLD)
    return ledger.status_report(spark, book, _approved(spark, sf))


def _implied_status(spark: SparkSession, sf: str) -> DataFrame:
    ros = _roster(spark, sf)
    report = similarity_report(ros, _vectors(spark, sf), THRESHOLD)
    row = one_row(
        implied.pair_stats(ros),
        implied.url_progress(ros, _features(spark, sf, "urlCheck")),
        implied.content_progress(ros, _features(spark, sf, "contentHash")),
        similarity_progress(ros, report),
        reports.approved_count(_approved(spark, sf)),
    )
    return _rounded(_whole_numbers(row), "avg_similarity_score", "overall_avg_similarity")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = _article_queries()
    if corpus:
        made |= corpus.queries() | {"pipeline": corpus_pipeline.run}
    return made


def _article_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ids_valid": lambda s, d: id_files.known_ids(
            id_files.distinct_ids(_id_lines(s, d)), _articles(s, d)),
        "ids_invalid": lambda s, d: id_files.unknown_ids(
            id_files.distinct_ids(_id_lines(s, d)), _articles(s, d)),
        "ids_rejected_lines": lambda s, d: id_files.rejected_lines(_id_lines(s, d)),
        "id_file_quality": lambda s, d: id_files.id_file_quality(_id_lines(s, d), _articles(s, d)),
        "approved_ids": lambda s, d: tables.approved_ids(_turns(s, d)).orderBy("articleId"),
        "approved_count": lambda s, d: reports.approved_count(_turns(s, d)),
        "pairs_load_result": lambda s, d: _whole_numbers(implied.load_result(*_log(s, d))),
        "pairs_stats": lambda s, d: _whole_numbers(implied.pair_stats(_roster(s, d))),
        "pairs_insert_or_ignore": lambda s, d: _loaded(s, d).select(*tables.PAIR),
        "pairs_inserted": lambda s, d: ratings.new_ratings(
            ratings.insert_or_ignore(tables.empty_ratings(s), _source_pairs(s, d), RUN_TS),
            _copy_pairs(s, d), RUN_TS).select(*tables.PAIR),
        "pairs_existing_count": lambda s, d: ratings.existing_pair_count(
            _loaded(s, d), _ids(s, d, "labels", "doc_id")),
        "pairs_rating_stats": lambda s, d: reports.pair_stats(_loaded(s, d)),
        "url_canonical": lambda s, d: with_canonical_url(_articles(s, d)),
        "url_domain": lambda s, d: with_canonical_url(_articles(s, d)).select(
            "id", domain_of("canonicalUrl").alias("domain")),
        "url_pending": lambda s, d: ratings.pending_with(
            _stored(s, d), "urlCheck", _articles(s, d), "id", "url"),
        "url_pair_scores": lambda s, d: _cells(_scored(s, d, "urlCheck"), "urlCheck"),
        "url_exact_matches": lambda s, d: _cells(
            ratings.exact_matches(_scored(s, d, "urlCheck"), "urlCheck"), "urlCheck"),
        "url_run_result": lambda s, d: reports.url_run_result(_scored(s, d, "urlCheck")),
        "url_status": lambda s, d: reports.url_status(_scored(s, d, "urlCheck")),
        "url_sample_topk": _sample,
        "url_duplicate_report": lambda s, d: implied.match_report(
            _everyone(_articles(s, d).select(F.col("id").alias("articleId"))),
            _features(s, d, "urlCheck"), exclude_self=True),
        "url_implied_progress": lambda s, d: _whole_numbers(
            implied.url_progress(_roster(s, d), _features(s, d, "urlCheck"))),
        "content_hash": lambda s, d: features.content_features(_approved(s, d)),
        "content_hash_first_approval": lambda s, d: features.content_features(_turns(s, d)),
        "content_pair_scores": lambda s, d: _cells(_scored(s, d, "contentHash"), "contentHash"),
        "content_run_result": lambda s, d: reports.content_run_result(_scored(s, d, "contentHash")),
        "content_status": lambda s, d: reports.content_status(_scored(s, d, "contentHash")),
        "content_match_report": lambda s, d: implied.match_report(
            _roster(s, d), _features(s, d, "contentHash")),
        "content_duplicate_report": lambda s, d: implied.match_report(
            _everyone(_ids(s, d, "documents", "doc_id")), _features(s, d, "contentHash"),
            exclude_self=True),
        "content_match_groups": lambda s, d: _whole_numbers(
            implied.match_groups(_roster(s, d), _features(s, d, "contentHash"))),
        "content_match_members": lambda s, d: implied.match_members(
            _roster(s, d), _features(s, d, "contentHash")),
        "content_implied_progress": lambda s, d: _whole_numbers(
            implied.content_progress(_roster(s, d), _features(s, d, "contentHash"))),
        "near_text_classes": lambda s, d: near_texts.text_classes(_approved(s, d)),
        "near_text_sets": lambda s, d: near_texts.class_sets(_approved(s, d)).drop("shingles"),
        "near_text_pairs": lambda s, d: _rounded(
            _whole_numbers(near_texts.near_text_pairs(_approved(s, d))), "similarity"),
        "near_text_report": lambda s, d: _rounded(
            near_texts.near_text_report(_approved(s, d)), "bestSimilarity"),
        "embedding_text": lambda s, d: features.article_texts(_turns(s, d).unionByName(
            _approved(s, d).withColumn("articleId", F.col("articleId") + 1_000_000_000))),
        "embedding_from_text": _letter_vectors,
        "embedding_pair_cosine": lambda s, d: _cells(_scored(s, d, "embeddingSearch"), "embeddingSearch"),
        "embedding_high_similarity": lambda s, d: _cells(ratings.high_similarity(
            _scored(s, d, "embeddingSearch"), THRESHOLD), "embeddingSearch"),
        "embedding_failed_scores": lambda s, d: _cells(_failed(s, d), "embeddingSearch"),
        "embedding_failed_run_result": lambda s, d: _rounded(reports.embedding_run_result(
            _failed(s, d), THRESHOLD), "overall_avg_similarity"),
        "embedding_run_result": lambda s, d: _rounded(reports.embedding_run_result(
            _scored(s, d, "embeddingSearch"), THRESHOLD), "overall_avg_similarity"),
        "embedding_status": lambda s, d: _rounded(reports.embedding_status(
            _scored(s, d, "embeddingSearch"), THRESHOLD), "avg_similarity_score"),
        "embedding_best_matches": lambda s, d: _rounded(similarity_report(
            _everyone(_vectors(s, d).select("articleId")), _vectors(s, d), THRESHOLD,
            exclude_self=True), "total", "best"),
        "embedding_similar_pairs": lambda s, d: _rounded(_whole_numbers(similar_pairs(
            _everyone(_vectors(s, d).select("articleId")), _vectors(s, d), THRESHOLD)).select(
            "newClass", "approvedClass", "similarity", "pairs"), "similarity"),
        "embedding_pivot_pairs": lambda s, d: _rounded(_whole_numbers(pivot_pairs(
            _everyone(_vectors(s, d).select("articleId")), _vectors(s, d), THRESHOLD)).select(
            "newClass", "approvedClass", "similarity", "pairs"), "similarity"),
        "embedding_high_report": lambda s, d: _rounded(high_report(
            _everyone(_vectors(s, d).select("articleId")), _vectors(s, d), THRESHOLD), "best"),
        "embedding_implied_progress": _implied_similarity,
        "state_overlap": lambda s, d: _rounded(state_overlap.state_overlap(
            _part_pairs(s, d), _part_states(s, d)), "signatureMatchState"),
        "state_progress": lambda s, d: _rounded(state_overlap.state_progress(state_overlap.state_overlap(
            _part_pairs(s, d), _part_states(s, d)), 0.1), "avg_overlap"),
        "date_pair_scores": lambda s, d: _rounded(date_proximity.date_scores(
            _order_pairs(s, d), _order_days(s, d), 365), "signatureMatchDate"),
        "date_matches": lambda s, d: _rounded(_whole_numbers(date_proximity.day_matches(
            _everyone(_ids(s, d, "orders", "o_orderkey")), _order_days(s, d))), "proximity"),
        "date_report": lambda s, d: date_proximity.date_report(
            _everyone(_ids(s, d, "orders", "o_orderkey")), _order_days(s, d)),
        "date_progress": lambda s, d: _rounded(_whole_numbers(date_proximity.date_progress(date_proximity.day_matches(
            _everyone(_ids(s, d, "orders", "o_orderkey")), _order_days(s, d)))), "proximity_sum"),
        "ratings_pending_count": lambda s, d: _scored(s, d, "embeddingSearch").agg(*(
            F.count_if(F.col(m).isNull()).alias(f"pending_{m}") for m in tables.METRICS)),
        "ratings_fill_pending": lambda s, d: _cells(_all_scored(s, d), *tables.METRICS),
        "ratings_bucketed_fill": lambda s, d: _cells(_bucketed(s, d), *tables.METRICS),
        "ratings_composite": lambda s, d: _rounded(ratings.composite_scores(
            _all_scored(s, d), WEIGHTS), "score", "scoreWeighted"),
        "ratings_recompute": _recomputed,
        "ratings_limited_pass": _limited,
        "ratings_fill_keeps_scores": _filled,
        "ratings_clear": _cleared,
        "ratings_reset": lambda s, d: one_row(
            _loaded(s, d).agg(F.count("*").alias("deleted")),
            ratings.reset(_loaded(s, d), confirm=True).agg(F.count("*").alias("remaining"))),
        "run_records": _run_records,
        "status_report": lambda s, d: _rounded(reports.status_report(
            _all_scored(s, d), _approved(s, d), THRESHOLD), "avg_similarity_score"),
        "status_report_ledger": lambda s, d: _rounded(_ledger_status(s, d), "avg_similarity_score"),
        "status_report_implied": _implied_status,
    }


def entry(spark: SparkSession) -> DataFrame:
    """Each document with its number of exact copies and one of them."""
    return queries()["content_duplicate_report"](spark, "/root/testdata/sf0.001")


# ----------------------------------------------------------------------------- oracle

_NORM = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', ' ', 'g'))"


def _key_sql(headline: str, text: str) -> str:
    return f"sha256({_NORM.format(headline)} || '|||' || {_NORM.format(text)})"


# Tracking keys that a canonical URL loses.
_TRACKING = (
    "'utm_source','utm_medium','utm_campaign','utm_term','utm_content','gclid','fbclid','msclkid',"
    "'dclid','gclsrc','_ga','_gl','mc_eid','mc_cid','ref','referrer','source','campaign','ncid'"
)

_LINES = """lines AS (
    SELECT doc_id::VARCHAR AS rawId FROM labels
    UNION ALL SELECT ' +' || conv_id || ' ' FROM conversations
    UNION ALL SELECT source FROM documents
    UNION ALL SELECT event_id || '.0' FROM events
    UNION ALL SELECT o_custkey::VARCHAR FROM orders),
parsed AS (
    SELECT rawId, CASE WHEN regexp_full_match(trim(rawId), '[+-]?[0-9]+')
        THEN trim(rawId)::BIGINT END AS articleId, coalesce(trim(rawId), '') = '' AS blank FROM lines)"""

_URLS = rf"""parts AS (
    SELECT page_id AS id, url,
        regexp_extract(lower(trim(url)), '^https?://([^/?#]*)', 1) AS host,
        regexp_extract(lower(trim(url)), '^https?://[^/?#]*([^?#]*)', 1) AS path,
        list_sort(list_filter(
            string_split(regexp_extract(lower(trim(url)), '^[^?#]*\?([^#]*)', 1), '&'),
            lambda x: x LIKE '%=_%' AND split_part(x, '=', 1) NOT IN ({_TRACKING}))) AS fields
    FROM pages),
urls AS (
    SELECT id, url,
        CASE WHEN host <> '' THEN 'https://'
            || regexp_replace(regexp_replace(host, ':(80|443)$', ''),
                '^(?:www|www2|www3|m|mobile)\.([^.]*\.)', '\1')
            || CASE WHEN regexp_replace(path, '/+$', '') = '' THEN '/'
                ELSE replace(regexp_replace(path, '/+$', ''), '%20', ' ') END
            || CASE WHEN len(fields) > 0 THEN '?' || array_to_string(fields, '&') ELSE '' END
        END AS canonicalUrl
    FROM parts)"""

_KEYS = f"""keys AS (
    SELECT doc_id AS articleId, {_key_sql("split_part(text, chr(10), 1)", "text")} AS key FROM documents)"""

# The five-word shingles of each class of equal texts, and the pairs of classes that share three in four of them.
_NEAR = f"""{_KEYS},
classes AS (SELECT key, min(articleId) AS classId, count(*) AS articles FROM keys GROUP BY key),
words AS (
    SELECT classId, articles, list_filter(string_split({_NORM.format("split_part(text, chr(10), 1)")} || ' '
        || {_NORM.format("text")}, ' '), lambda w: w <> '') AS w
    FROM classes JOIN documents ON doc_id = classId),
sets AS (
    SELECT classId, articles, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
    FROM words),
shingles AS (SELECT classId, len(s) AS size, unnest(s) AS x FROM sets),
near AS (
    SELECT a.classId, b.classId AS otherId, count(*) AS common, a.size, b.size AS otherSize,
        count(*) / (a.size + b.size - count(*)) AS similarity
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.classId < b.classId
    GROUP BY a.classId, b.classId, a.size, b.size HAVING 175 * count(*) >= 75 * (a.size + b.size))"""

_VECS = "vecs AS (SELECT vec_id AS articleId, embedding::DOUBLE[] AS v FROM embeddings)"

_COSINE = "greatest(0.0, list_cosine_similarity({0}, {1}))"

# Parts as articles, suppliers as states; pairs of each part with the first of its brand.
_STATES = """states AS (SELECT DISTINCT l_partkey AS articleId, l_suppkey AS stateId FROM lineitem
    WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL),
counts AS (SELECT articleId, count(*) AS c FROM states GROUP BY articleId),
every AS (SELECT p_partkey AS n, min(p_partkey) OVER (PARTITION BY p_brand) AS a FROM part WHERE p_brand IS NOT NULL),
met AS (SELECT n, a, count(y.stateId) AS c FROM every JOIN states x ON x.articleId = n
    LEFT JOIN states y ON y.articleId = a AND y.stateId = x.stateId GROUP BY n, a),
overlap AS (
    SELECT e.n AS articleIdNew, e.a AS articleIdApproved, CAST(x.c AS BIGINT) AS newStates, CAST(y.c AS BIGINT) AS approvedStates,
        CASE WHEN x.c IS NOT NULL AND y.c IS NOT NULL THEN met.c END AS commonStates,
        CASE WHEN x.c IS NOT NULL AND y.c IS NOT NULL THEN met.c / (x.c + y.c - met.c) END AS signatureMatchState
    FROM every e LEFT JOIN counts x ON x.articleId = n LEFT JOIN counts y ON y.articleId = a
        LEFT JOIN met ON met.n = e.n AND met.a = e.a WHERE e.n <> e.a)"""

# Orders as articles, and days less than a week apart.
_DAYS = """days AS (SELECT o_orderkey AS articleId, CAST(min(datediff('day', DATE '1970-01-01', o_orderdate::DATE)) AS BIGINT) AS day
    FROM orders WHERE o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL GROUP BY o_orderkey),
classes AS (SELECT day, count(*) AS c, min(articleId) AS first FROM days GROUP BY day),
met AS (SELECT x.day AS newDay, y.day AS approvedDay, abs(x.day - y.day) AS days, x.c AS newArticles,
    y.c AS approvedArticles, y.first AS approvedFirst FROM classes x JOIN classes y ON abs(x.day - y.day) < 7)"""

_PAIRS = f"""{_KEYS}, {_URLS},
every_source AS (
    SELECT doc_id AS n, min(doc_id) OVER (PARTITION BY source) AS a FROM documents WHERE source IS NOT NULL),
source_pairs AS (SELECT * FROM every_source WHERE n <> a),
every_copy AS (SELECT articleId AS n, min(articleId) OVER (PARTITION BY key) AS a FROM keys),
copy_pairs AS (SELECT * FROM every_copy WHERE n <> a),
loaded AS (
    SELECT * FROM source_pairs UNION SELECT * FROM copy_pairs
    UNION SELECT * FROM (SELECT id AS n, min(id) OVER (PARTITION BY canonicalUrl) AS a
        FROM urls WHERE canonicalUrl IS NOT NULL) WHERE n <> a
    UNION SELECT * FROM (SELECT id AS n, min(id) OVER (PARTITION BY split_part(canonicalUrl, '/', 3)) AS a
        FROM urls WHERE canonicalUrl IS NOT NULL) WHERE n <> a
    UNION SELECT * FROM (SELECT vec_id AS n, min(vec_id) OVER (PARTITION BY label) AS a
        FROM embeddings WHERE label IS NOT NULL) WHERE n <> a)"""

_FAILED = """bad AS (SELECT articleId, CASE articleId % 5 WHEN 0 THEN NULL WHEN 1 THEN v[1:8] ELSE v END AS v FROM vecs),
tried AS (
    SELECT n AS articleIdNew, a AS articleIdApproved, x.articleId IS NOT NULL AND y.articleId IS NOT NULL AS done,
        CASE WHEN len(x.v) = len(y.v) THEN greatest(0.0, list_cosine_similarity(x.v, y.v)) END AS c
    FROM loaded LEFT JOIN bad x ON x.articleId = n LEFT JOIN bad y ON y.articleId = a)"""

_RATED = f"""{_PAIRS}, {_VECS},
rated AS (
    SELECT n AS articleIdNew, a AS articleIdApproved,
        CASE WHEN u1.id IS NOT NULL AND u2.id IS NOT NULL
            THEN coalesce(u1.canonicalUrl = u2.canonicalUrl, false)::INT::DOUBLE END AS urlCheck,
        (k1.key = k2.key)::INT::DOUBLE AS contentHash,
        CASE WHEN v1.articleId IS NOT NULL AND v2.articleId IS NOT NULL
            THEN {_COSINE.format("v1.v", "v2.v")} END AS embeddingSearch
    FROM loaded
    LEFT JOIN urls u1 ON u1.id = n LEFT JOIN urls u2 ON u2.id = a
    LEFT JOIN keys k1 ON k1.articleId = n LEFT JOIN keys k2 ON k2.articleId = a
    LEFT JOIN vecs v1 ON v1.articleId = n LEFT JOIN vecs v2 ON v2.articleId = a)"""

_IMPLIED = f"""first_load AS (SELECT vec_id AS n, page_id AS a FROM embeddings, pages),
second_load AS (SELECT DISTINCT l.doc_id AS n, d.doc_id AS a FROM labels l, documents d),
implied AS (SELECT * FROM first_load UNION SELECT * FROM second_load),
{_KEYS}, {_URLS}, {_VECS}"""

_MATCHED = "SELECT n, a, k1.key FROM implied JOIN keys k1 ON k1.articleId = n JOIN keys k2 ON k2.articleId = a AND k2.key = k1.key"


def _percent(part: str, whole: str, digits: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN round_even({part} / {whole} * 100, {digits}) ELSE 0.0 END"


def _floor(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN ({part} * 100) // {whole} ELSE 0 END"


_URL_FIGURES = """count(*) AS total_pairs, count(urlCheck) AS url_check_completed,
    count(*) - count(urlCheck) AS url_check_pending,
    count(*) FILTER (urlCheck = 1) AS matching_urls"""
_URL_PERCENT = (
    f"{_percent('url_check_completed', 'total_pairs', 1)} AS completion_percentage, "
    f"{_percent('matching_urls', 'url_check_completed', 1)} AS match_percentage"
)
_CONTENT_FIGURES = """count(contentHash) AS content_hash_completed,
    count(*) - count(contentHash) AS content_hash_pending,
    count(*) FILTER (contentHash = 1) AS matching_content"""
_CONTENT_PERCENT = (
    f"{_floor('content_hash_completed', 'total_pairs')} AS content_completion_percentage, "
    f"{_floor('matching_content', 'content_hash_completed')} AS content_match_percentage"
)
_EMBEDDING_FIGURES = f"""count(embeddingSearch) AS embedding_search_completed,
    count(*) - count(embeddingSearch) AS embedding_search_pending,
    count(*) FILTER (embeddingSearch > {THRESHOLD}) AS high_similarity_pairs,
    coalesce(round(avg(embeddingSearch), 6), 0.0) AS avg_similarity_score"""
_EMBEDDING_PERCENT = (
    f"{_floor('embedding_search_completed', 'total_pairs')} AS embedding_completion_percentage"
)

_IMPLIED_RATED = f"""{_IMPLIED},
rated AS (
    SELECT n AS articleIdNew, a AS articleIdApproved,
        CASE WHEN u1.id IS NOT NULL AND u2.id IS NOT NULL
            THEN coalesce(u1.canonicalUrl = u2.canonicalUrl, false)::INT::DOUBLE END AS urlCheck,
        (k1.key = k2.key)::INT::DOUBLE AS contentHash,
        CASE WHEN v1.articleId IS NOT NULL AND v2.articleId IS NOT NULL
            THEN {_COSINE.format("v1.v", "v2.v")} END AS embeddingSearch
    FROM implied
    LEFT JOIN urls u1 ON u1.id = n LEFT JOIN urls u2 ON u2.id = a
    LEFT JOIN keys k1 ON k1.articleId = n LEFT JOIN keys k2 ON k2.articleId = a
    LEFT JOIN vecs v1 ON v1.articleId = n LEFT JOIN vecs v2 ON v2.articleId = a)"""


def _duplicates(members: str) -> str:
    """Per member the others of its key; the partner is the lowest other, see match_report."""
    return f"""SELECT x.articleId, x.key, count(*) AS matches,
        CASE WHEN min(y.articleId) > x.articleId THEN max(y.articleId) ELSE min(y.articleId) END AS partnerId
    FROM {members} x JOIN {members} y ON x.key = y.key AND x.articleId <> y.articleId
    GROUP BY x.articleId, x.key"""


def oracle_sql() -> dict[str, str]:
    made = _article_sql()
    if corpus:
        made |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            made["pipeline"] = corpus_pipeline.ORACLE_SQL
    return made


def _article_sql() -> dict[str, str]:
    letters = ", ".join(
        f"(len(t) - len(replace(t, '{chr(97 + i)}', '')))::BIGINT AS {chr(97 + i)}" for i in range(26)
    )
    combined = (
        "CASE WHEN {h} <> '' AND {t} <> '' THEN {h} || '. ' || {t} WHEN {h} <> '' THEN {h} ELSE {t} END"
    )
    strip = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
    doc_text = combined.format(h=strip.format("split_part(text, chr(10), 1)"), t=strip.format("text"))
    turn_text = combined.format(h=strip.format("role"), t=strip.format("text"))
    first_turn = "FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1"
    vector_pairs = f"""SELECT x.articleId, y.articleId AS other, {_COSINE.format("x.v", "y.v")} AS c
        FROM vecs x JOIN vecs y ON x.articleId <> y.articleId"""
    return {
        "ids_valid": f"WITH {_LINES} SELECT DISTINCT articleId FROM parsed "
            "WHERE articleId IN (SELECT page_id FROM pages)",
        "ids_invalid": f"WITH {_LINES} SELECT DISTINCT articleId FROM parsed "
            "WHERE articleId IS NOT NULL AND articleId NOT IN (SELECT page_id FROM pages)",
        "ids_rejected_lines": f"WITH {_LINES} SELECT rawId FROM parsed WHERE articleId IS NULL AND NOT blank",
        "id_file_quality": f"""WITH {_LINES}
            SELECT count(*) AS line_count, count(*) FILTER (blank) AS blank,
                count(*) FILTER (articleId IS NULL AND NOT blank) AS malformed,
                count(articleId) - count(DISTINCT articleId) AS repeated,
                count(DISTINCT articleId) FILTER (articleId IN (SELECT page_id FROM pages)) AS known,
                count(DISTINCT articleId) FILTER (articleId NOT IN (SELECT page_id FROM pages)) AS unknown,
                count(*) FILTER (articleId IS NULL AND NOT blank) = 0 AS valid_format
            FROM parsed""",
        "approved_ids": "SELECT DISTINCT conv_id AS articleId FROM conversations ORDER BY 1",
        "approved_count": "SELECT count(DISTINCT conv_id) AS approved_articles FROM conversations",
        "pairs_load_result": f"""WITH {_IMPLIED}, n AS (
                SELECT (SELECT count(*) FROM implied) AS after, (SELECT count(*) FROM first_load) AS before,
                    (SELECT count(*) FROM second_load) AS possible)
            SELECT after - before AS new_pairs, possible - (after - before) AS existing_pairs,
                after AS total_pairs, (SELECT count(DISTINCT doc_id) FROM labels) AS csv_articles_loaded,
                (SELECT count(*) FROM documents) AS approved_articles FROM n""",
        "pairs_stats": f"""WITH {_IMPLIED} SELECT count(*) AS total_pairs,
            count(DISTINCT n) AS unique_new_articles, count(DISTINCT a) AS unique_approved_articles
            FROM implied""",
        "pairs_insert_or_ignore":
            f"WITH {_PAIRS} SELECT n AS articleIdNew, a AS articleIdApproved FROM loaded",
        "pairs_inserted": f"""WITH {_PAIRS} SELECT n AS articleIdNew, a AS articleIdApproved FROM (
            SELECT * FROM copy_pairs EXCEPT SELECT * FROM source_pairs)""",
        "pairs_existing_count": f"""WITH {_PAIRS} SELECT count(*) AS existing_pairs FROM loaded
            WHERE n IN (SELECT doc_id FROM labels)""",
        "pairs_rating_stats": f"""WITH {_PAIRS} SELECT count(*) AS total_pairs,
            count(DISTINCT n) AS unique_new_articles, count(DISTINCT a) AS unique_approved_articles
            FROM loaded""",
        "url_canonical": f"WITH {_URLS} SELECT id, url, canonicalUrl FROM urls",
        "url_domain": f"WITH {_URLS} SELECT id, split_part(canonicalUrl, '/', 3) AS domain FROM urls",
        "url_pending": f"""WITH {_PAIRS} SELECT n AS articleIdNew, a AS articleIdApproved,
            p1.url AS urlNew, p2.url AS urlApproved
            FROM loaded JOIN pages p1 ON p1.page_id = n JOIN pages p2 ON p2.page_id = a""",
        "url_pair_scores": f"WITH {_RATED} SELECT articleIdNew, articleIdApproved, urlCheck FROM rated",
        "url_exact_matches":
            f"WITH {_RATED} SELECT articleIdNew, articleIdApproved, urlCheck FROM rated WHERE urlCheck = 1",
        "url_run_result": f"""WITH {_RATED}, f AS (SELECT count(urlCheck) AS processed_pairs,
            count(*) FILTER (urlCheck = 1) AS url_matches_found FROM rated)
            SELECT *, {_percent('url_matches_found', 'processed_pairs', 2)} AS match_rate FROM f""",
        "url_status": f"WITH {_RATED}, f AS (SELECT {_URL_FIGURES} FROM rated) SELECT *, {_URL_PERCENT} FROM f",
        "url_sample_topk": f"""WITH {_RATED} SELECT articleIdNew, articleIdApproved, urlCheck,
            u1.url AS urlNew, u2.url AS urlApproved,
            u1.canonicalUrl AS canonicalNew, u2.canonicalUrl AS canonicalApproved
            FROM rated JOIN urls u1 ON u1.id = articleIdNew JOIN urls u2 ON u2.id = articleIdApproved
            WHERE urlCheck IS NOT NULL ORDER BY urlCheck DESC, articleIdNew, articleIdApproved LIMIT 10""",
        "url_duplicate_report": f"""WITH {_URLS}, m AS (
            SELECT id AS articleId, sha256(canonicalUrl) AS key FROM urls) {_duplicates('m')}""",
        "url_implied_progress": f"""WITH {_IMPLIED_RATED}, f AS (SELECT {_URL_FIGURES} FROM rated)
            SELECT *, {_URL_PERCENT} FROM f""",
        "content_hash": f"WITH {_KEYS} SELECT articleId, key FROM keys",
        "content_hash_first_approval":
            f"SELECT conv_id AS articleId, {_key_sql('role', 'text')} AS key {first_turn}",
        "content_pair_scores":
            f"WITH {_RATED} SELECT articleIdNew, articleIdApproved, contentHash FROM rated",
        "content_run_result": f"""WITH {_RATED}, f AS (SELECT count(contentHash) AS processed,
            count(*) FILTER (contentHash = 1) AS matches, count(*) FILTER (contentHash = 0) AS non_matches,
            0::BIGINT AS errors FROM rated)
            SELECT *, {_floor('matches', 'processed')} AS match_rate FROM f""",
        "content_status": f"""WITH {_RATED}, f AS (
            SELECT count(*) AS total_pairs, {_CONTENT_FIGURES} FROM rated)
            SELECT *, {_CONTENT_PERCENT} FROM f""",
        "content_match_report": f"""WITH {_IMPLIED}, m AS ({_MATCHED})
            SELECT n AS articleId, key, count(*) AS matches, min(a) AS partnerId FROM m GROUP BY n, key""",
        "content_duplicate_report": f"WITH {_KEYS} {_duplicates('keys')}",
        "content_match_groups": f"""WITH {_IMPLIED}, m AS ({_MATCHED}), g AS (
                SELECT key, count(*) AS pairs FROM m GROUP BY key)
            SELECT g.key,
                (SELECT count(*) FROM keys k WHERE k.key = g.key AND k.articleId IN (SELECT n FROM implied))
                    AS newArticles,
                (SELECT count(*) FROM keys k WHERE k.key = g.key AND k.articleId IN (SELECT a FROM implied))
                    AS approvedArticles,
                g.pairs,
                (SELECT min(k.articleId) FROM keys k WHERE k.key = g.key
                    AND k.articleId IN (SELECT a FROM implied)) AS firstApproved
            FROM g""",
        "content_match_members": f"""WITH {_IMPLIED}, m AS ({_MATCHED})
            SELECT key, articleId,
                CASE WHEN articleId IN (SELECT doc_id FROM labels) THEN 2
                    WHEN articleId IN (SELECT vec_id FROM embeddings) THEN 1 END::INT AS newLoad,
                CASE WHEN articleId IN (SELECT page_id FROM pages) THEN 1 ELSE 2 END::INT AS approvedLoad
            FROM keys WHERE key IN (SELECT key FROM m)""",
        "content_implied_progress": f"""WITH {_IMPLIED_RATED}, f AS (
            SELECT count(*) AS total_pairs, {_CONTENT_FIGURES} FROM rated)
            SELECT *, {_CONTENT_PERCENT} FROM f""",
        "near_text_classes": f"""WITH {_KEYS},
            classes AS (SELECT key, min(articleId) AS classId, count(*) AS articles FROM keys GROUP BY key)
            SELECT articleId, classId, articles FROM keys JOIN classes USING (key)""",
        "near_text_sets": f"""WITH {_NEAR} SELECT classId, articles, CAST(len(s) AS BIGINT) AS size FROM sets""",
        "near_text_pairs": f"""WITH {_NEAR}
            SELECT n.classId, otherId, common, size, otherSize, round(similarity, 6) AS similarity, a.articles * b.articles AS pairs
            FROM near n JOIN classes a ON a.classId = n.classId JOIN classes b ON b.classId = otherId""",
        "near_text_report": f"""WITH {_NEAR},
            sides AS (SELECT classId, otherId, similarity FROM near
                UNION ALL SELECT otherId, classId, similarity FROM near),
            links AS (SELECT l.classId, CAST(sum(articles) AS BIGINT) AS matches, max(similarity) AS best
                FROM sides l JOIN classes c ON c.classId = l.otherId GROUP BY l.classId),
            firsts AS (SELECT l.classId, min(otherId) AS bestId FROM sides l JOIN links k ON k.classId = l.classId
                WHERE similarity = best GROUP BY l.classId)
            SELECT articleId, c.classId, articles - 1 AS copies, coalesce(matches, 0) AS nearMatches, bestId,
                round(best, 6) AS bestSimilarity
            FROM keys JOIN classes c USING (key) LEFT JOIN links l ON l.classId = c.classId
                LEFT JOIN firsts f ON f.classId = c.classId""",
        "embedding_text": f"""SELECT conv_id AS articleId, {turn_text} AS combinedText {first_turn}
            UNION ALL SELECT doc_id + 1000000000, {doc_text} FROM documents""",
        "embedding_from_text": f"""WITH t AS (SELECT doc_id AS articleId, {doc_text} AS t FROM documents)
            SELECT articleId, {letters} FROM t""",
        "embedding_pair_cosine": f"""WITH {_RATED} SELECT articleIdNew, articleIdApproved,
            round(embeddingSearch, 6) AS embeddingSearch FROM rated""",
        "embedding_high_similarity": f"""WITH {_RATED} SELECT articleIdNew, articleIdApproved,
            round(embeddingSearch, 6) AS embeddingSearch FROM rated
            WHERE embeddingSearch > {THRESHOLD}""",
        "embedding_failed_scores": f"""WITH {_PAIRS}, {_VECS}, {_FAILED}
            SELECT articleIdNew, articleIdApproved,
                CASE WHEN done THEN round(coalesce(c, 0.0), 6) END AS embeddingSearch FROM tried""",
        "embedding_failed_run_result": f"""WITH {_PAIRS}, {_VECS}, {_FAILED}, f AS (
            SELECT count(*) FILTER (done) AS total_processed,
                count(*) FILTER (c > {THRESHOLD}) AS total_high_similarity,
                coalesce(round(avg(c), 6), 0.0) AS overall_avg_similarity,
                count(*) FILTER (done AND c IS NULL) AS total_errors FROM tried)
            SELECT *, {_floor('total_high_similarity', 'total_processed')} AS high_percentage FROM f""",
        "embedding_run_result": f"""WITH {_RATED}, f AS (
                SELECT count(embeddingSearch) AS total_processed,
                count(*) FILTER (embeddingSearch > {THRESHOLD}) AS total_high_similarity,
                coalesce(round(avg(embeddingSearch), 6), 0.0) AS overall_avg_similarity,
                0::BIGINT AS total_errors FROM rated)
            SELECT *, {_floor('total_high_similarity', 'total_processed')} AS high_percentage FROM f""",
        "embedding_status": f"""WITH {_RATED}, f AS (
            SELECT count(*) AS total_pairs, {_EMBEDDING_FIGURES} FROM rated)
            SELECT *, {_EMBEDDING_PERCENT} FROM f""",
        "embedding_best_matches": f"""WITH {_VECS}, p AS ({vector_pairs})
            SELECT articleId, count(*) AS compared, 0::BIGINT AS failed,
                count(*) FILTER (c > {THRESHOLD}) AS high, round(sum(c), 6) AS total,
                round(max(c), 6) AS best,
                (list(other ORDER BY round(c, 12) DESC, other))[1] AS bestId
            FROM p GROUP BY articleId""",
        "embedding_similar_pairs": f"""WITH {_VECS},
            c AS (SELECT *, min(articleId) OVER (PARTITION BY v) AS cls FROM vecs),
            p AS (SELECT x.cls AS newClass, y.cls AS approvedClass, {_COSINE.format("x.v", "y.v")} AS c
                FROM c x JOIN c y ON x.articleId <> y.articleId)
            SELECT newClass, approvedClass, round(max(c), 6) AS similarity, count(*) AS pairs
            FROM p WHERE c > {THRESHOLD} GROUP BY ALL""",
        "embedding_high_report": f"""WITH {_VECS}, p AS (
                SELECT x.articleId, y.articleId AS other, {_COSINE.format("x.v", "y.v")} AS c FROM vecs x, vecs y)
            SELECT articleId, count(*) AS high, round(max(c), 6) AS best,
                (list(other ORDER BY round(c, 12) DESC, other))[1] AS bestId
            FROM p WHERE c > {THRESHOLD} GROUP BY articleId""",
        "embedding_pivot_pairs": f"""WITH {_VECS},
            c AS (SELECT *, min(articleId) OVER (PARTITION BY v) AS cls FROM vecs),
            p AS (SELECT x.cls AS newClass, y.cls AS approvedClass, {_COSINE.format("x.v", "y.v")} AS c
                FROM c x JOIN c y ON x.articleId <> y.articleId)
            SELECT newClass, approvedClass, round(max(c), 6) AS similarity, count(*) AS pairs
            FROM p WHERE c > {THRESHOLD} GROUP BY ALL""",
        "state_overlap": f"""WITH {_STATES} SELECT * REPLACE (round(signatureMatchState, 6) AS signatureMatchState) FROM overlap""",
        "state_progress": f"""WITH {_STATES}
            SELECT count(*) AS total_pairs, count(signatureMatchState) AS state_completed,
                count(*) - count(signatureMatchState) AS state_pending,
                count(*) FILTER (signatureMatchState = 1) AS equal_states,
                count(*) FILTER (signatureMatchState > 0.1) AS high_overlap,
                round(coalesce(avg(signatureMatchState), 0), 6) AS avg_overlap
            FROM overlap""",
        "date_pair_scores": f"""WITH {_DAYS},
            every AS (SELECT o_orderkey AS n, min(o_orderkey) OVER (PARTITION BY o_custkey) AS a FROM orders WHERE o_custkey IS NOT NULL)
            SELECT n AS articleIdNew, a AS articleIdApproved, round(greatest(0.0, 1 - abs(x.day - y.day) / 365.0::DOUBLE), 6) AS signatureMatchDate
            FROM every LEFT JOIN days x ON x.articleId = n LEFT JOIN days y ON y.articleId = a WHERE n <> a""",
        "date_matches": f"""WITH {_DAYS}
            SELECT newDay, 1 AS newLoad, approvedDay, 1 AS approvedLoad, days, round(1 - days / 7.0::DOUBLE, 6) AS proximity,
                newArticles, approvedArticles, approvedFirst, newArticles * approvedArticles AS pairs FROM met""",
        "date_report": f"""WITH {_DAYS}
            SELECT articleId, CAST(sum(approvedArticles) AS BIGINT) AS nearDates, min(days) AS days,
                (list(approvedFirst ORDER BY days, approvedFirst))[1] AS nearestId
            FROM days JOIN met ON newDay = day GROUP BY articleId""",
        "date_progress": f"""WITH {_DAYS}
            SELECT CAST(sum(newArticles * approvedArticles) AS BIGINT) AS near_pairs,
                CAST(coalesce(sum(newArticles * approvedArticles) FILTER (days = 0), 0) AS BIGINT) AS same_day_pairs,
                round(coalesce(sum((1 - days / 7.0::DOUBLE) * newArticles * approvedArticles), 0.0), 6) AS proximity_sum FROM met""",
        "embedding_implied_progress": f"""WITH {_IMPLIED_RATED}, f AS (
            SELECT count(*) AS total_pairs, {_EMBEDDING_FIGURES},
                coalesce(round(avg(embeddingSearch), 6), 0.0) AS overall_avg_similarity,
                0::BIGINT AS total_errors FROM rated)
            SELECT *, {_EMBEDDING_PERCENT} FROM f""",
        "ratings_pending_count": f"""WITH {_RATED} SELECT count(*) AS pending_urlCheck,
            count(*) AS pending_contentHash, count(*) - count(embeddingSearch) AS pending_embeddingSearch
            FROM rated""",
        "ratings_fill_pending": f"""WITH {_RATED} SELECT articleIdNew, articleIdApproved, urlCheck,
            contentHash, round(embeddingSearch, 6) AS embeddingSearch FROM rated""",
        "ratings_bucketed_fill": f"""WITH {_RATED} SELECT articleIdNew, articleIdApproved, urlCheck,
            contentHash, round(embeddingSearch, 6) AS embeddingSearch FROM rated""",
        "ratings_composite": f"""WITH {_RATED}, p AS (SELECT *,
                (urlCheck IS NOT NULL)::INT AS u, (contentHash IS NOT NULL)::INT AS k,
                (embeddingSearch IS NOT NULL)::INT AS e, coalesce(urlCheck, 0.0) AS us,
                coalesce(contentHash, 0.0) AS ks, coalesce(embeddingSearch, 0.0) AS es FROM rated)
            SELECT articleIdNew, articleIdApproved,
                CASE WHEN u + k + e > 0 THEN round((us + ks + es) / (u + k + e), 6) END AS score,
                CASE WHEN u + k + e > 0 THEN round((3 * us + 2 * ks + es) / (3 * u + 2 * k + e), 6) END
                    AS scoreWeighted FROM p""",
        "run_records": f"""WITH {_PAIRS}, h AS (
                SELECT 'load' AS operation, n, a FROM source_pairs UNION ALL SELECT 'content', n, a FROM loaded),
            f AS (SELECT operation, count(*) AS inputRows, sum(('0x' || substr(md5(
                'articleIdApproved=' || a || chr(31) || 'articleIdNew=' || n), 1, 15))::HUGEINT)::VARCHAR AS inputHash
                FROM h GROUP BY operation),
            k AS (SELECT count(*) AS processed, count(*) FILTER (x.key = y.key) AS matches
                FROM loaded JOIN keys x ON x.articleId = n JOIN keys y ON y.articleId = a)
            SELECT f.*, CASE WHEN operation = 'load' THEN (SELECT count(*) FROM loaded) END AS total_pairs,
                CASE WHEN operation = 'content' THEN processed END AS processed,
                CASE WHEN operation = 'content' THEN matches END AS matches FROM f, k""",
        "ratings_recompute":
            f"WITH {_RATED} SELECT articleIdNew, articleIdApproved, contentHash FROM rated",
        "ratings_limited_pass": f"""WITH {_RATED}, first AS (
                SELECT articleIdNew, articleIdApproved, contentHash FROM rated WHERE contentHash IS NOT NULL
                ORDER BY articleIdNew, articleIdApproved LIMIT 100)
            SELECT articleIdNew, articleIdApproved, f.contentHash
            FROM rated LEFT JOIN first f USING (articleIdNew, articleIdApproved)""",
        "ratings_fill_keeps_scores": f"""WITH {_RATED} SELECT articleIdNew, articleIdApproved,
            CASE WHEN articleIdNew % 2 = 0 THEN 0.5::DOUBLE ELSE contentHash END AS contentHash,
            articleIdNew % 2 <> 0 AND contentHash IS NOT NULL AS touched FROM rated""",
        "ratings_clear": f"""WITH {_RATED} SELECT count(*) AS cleared_urlCheck,
            count(contentHash) AS cleared_contentHash, count(embeddingSearch) AS cleared_embeddingSearch,
            0::BIGINT AS left_urlCheck, count(contentHash) AS left_contentHash,
            count(embeddingSearch) AS left_embeddingSearch FROM rated""",
        "ratings_reset":
            f"WITH {_PAIRS} SELECT count(*) AS deleted, 0::BIGINT AS remaining FROM loaded",
        "status_report": f"""WITH {_RATED}, f AS (SELECT {_URL_FIGURES}, {_CONTENT_FIGURES},
                {_EMBEDDING_FIGURES}, count(DISTINCT articleIdNew) AS unique_new_articles,
                count(DISTINCT articleIdApproved) AS unique_approved_articles,
                (SELECT count(*) FROM documents) AS approved_articles FROM rated)
            SELECT *, unique_new_articles AS csv_articles_loaded, {_URL_PERCENT}, {_CONTENT_PERCENT},
                {_EMBEDDING_PERCENT} FROM f""",
        "status_report_ledger": f"""WITH {_RATED}, f AS (SELECT {_URL_FIGURES}, {_CONTENT_FIGURES},
                {_EMBEDDING_FIGURES}, count(DISTINCT articleIdNew) AS unique_new_articles,
                count(DISTINCT articleIdApproved) AS unique_approved_articles,
                (SELECT count(*) FROM documents) AS approved_articles FROM rated)
            SELECT *, unique_new_articles AS csv_articles_loaded, {_URL_PERCENT}, {_CONTENT_PERCENT},
                {_EMBEDDING_PERCENT} FROM f""",
        "status_report_implied": f"""WITH {_IMPLIED_RATED}, f AS (SELECT {_URL_FIGURES},
                {_CONTENT_FIGURES}, {_EMBEDDING_FIGURES},
                coalesce(round(avg(embeddingSearch), 6), 0.0) AS overall_avg_similarity,
                0::BIGINT AS total_errors, count(DISTINCT articleIdNew) AS unique_new_articles,
                count(DISTINCT articleIdApproved) AS unique_approved_articles,
                (SELECT count(*) FROM documents) AS approved_articles FROM rated)
            SELECT *, {_URL_PERCENT}, {_CONTENT_PERCENT}, {_EMBEDDING_PERCENT} FROM f""",
    }
