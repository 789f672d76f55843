"""Every registered query over the data tables, and its SQL counterpart."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope import oracle
from agorascope.config import Boilerplate
from agorascope.functions import text as X
from agorascope.operators import audit as A
from agorascope.operators import classify as K
from agorascope.operators import rows as R
from agorascope.operators import sections as S
from agorascope.plans import corpus as C
from agorascope.plans import engine as E
from agorascope.plans import jobs as J
from agorascope.plans.partials import STATES, Partials, cohort_states
from agorascope.plans.repeats import RepeatCounts
from agorascope.plans.store import read_or_none
from agorascope.plans.tables import PartitionedTable
from agorascope.plans.vectors import VectorIndex
from agorascope.session import cut, forget, kept, read, read_texts, shared_folder
from agorascope.streaming import admission
from agorascope.streaming import ingest as I

Query = Callable[[SparkSession, str], DataFrame]
#: Copies that make boilerplate in queries over the small derived corpus.
FEW = Boilerplate(min_repeats=1)


def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


def _items(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(C.items(spark, d))


#: What most sections use of an item.
BASE = ("id", "thread_id", "subreddit", "content_class", "ai_related", "created_utc")


def _several(build: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """As ``_items``, for sections that use the items several times: the few columns that they use are cut first."""
    return lambda spark, d: build(cut(C.items(spark, d).select(*BASE, *columns)))


def _framed(build) -> Query:
    return lambda spark, d: build(
        cut(C.items(spark, d).select(*BASE, "source", "author", "stance", "stance_basis", "intensity", "comment_mix")), C.SUB_TAGS, C.STREAM_KINDS,
    )


def _cosine(spark, d):
    vectors = read(spark, d, "embeddings").select("vec_id", X.l2_normalize(F.col("embedding").cast("array<double>")).alias("v"))
    target = vectors.where("vec_id = 0").first()["v"]  # one vector, as a question's would be
    scored = vectors.select("vec_id", F.round(X.dot(F.col("v"), F.array(*map(F.lit, target))), 5).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), "vec_id").limit(100)


def _base64(spark, d):
    rows = read(spark, d, "embeddings").withColumn("again", X.vector_from_base64(X.vector_to_base64(F.col("embedding"))))
    near = F.size(F.filter(F.zip_with("embedding", "again", lambda a, b: F.abs(a - b) < 1e-6), lambda same: same))
    return rows.select(
        "vec_id", F.size("again").cast("long").alias("n"), near.cast("long").alias("n_equal"),
        F.round(F.aggregate("again", F.lit(0.0), lambda s, x: s + x), 3).alias("total"),
    )


def _sub_mentions(spark, d):
    """Each page's host, in two spellings, and up to 39 more names, one of which is one's own."""
    host = F.regexp_replace(F.regexp_extract("url", "://([^/]*)", 1), "[^A-Za-z0-9]", "_")
    more = F.expr("array_join(transform(sequence(0, page_id % 40), i -> concat(' see r/Sub_', i)), ',')")
    text = F.concat("url", F.lit(" r/"), host, F.lit(" r/"), F.upper(host), more)
    return read(spark, d, "pages").select("page_id", F.array_join(X.sub_mentions(text, F.lit("SUB_3")), ",").alias("mentions"))


def _lists(items: DataFrame) -> DataFrame:
    found = S.meta_lists(items)
    return found.select(*[F.array_join(c, ",").alias(c) for c in found.columns])


def _registry(spark, d):
    titles = K.harvest(C.posts(spark, d), "title", "title", 40, 1)
    return K.merge_registry(K.harvest(C.comments(spark, d), "body", "comment-body", 120, 1), titles)


def _filtered(spark, d):
    comments = C.comments(spark, d)
    return K.filter_comments(comments, K.harvest(comments, "body", "comment-body", 120, 1)).groupBy("reason").agg(_n())


def _upsert(spark, d):
    rows = C.posts(spark, d).withColumn("q", F.expr("cast(substring(row_key, 2) as bigint) div 20"))
    old = rows.where("q % 2 = 0").select("subreddit", "row_key", "title", "analyzed")
    merged = R.merge_rows(old, rows.select("subreddit", "row_key", "title"), ["subreddit", "row_key"])
    return merged.groupBy("is_new").agg(
        _n(), F.sum(F.length("title")).alias("title_chars"), F.count_if(F.coalesce("analyzed", F.lit(False))).alias("analyzed"),
    )


def _new_rows(spark, d):
    """Half of the rows are stored; of the others each comes three times, the newest not the last."""
    rows = C.posts(spark, d).select("subreddit", "row_key", "created_utc", "title")
    stored = rows.where("(cast(substring(row_key, 2) as bigint) div 20) % 2 = 0")
    again = rows.withColumn("created_utc", F.col("created_utc") + 5).withColumn("title", F.lit("newest"))
    return R.admit(stored, rows.unionByName(again).unionByName(rows), ["subreddit", "row_key"])


def _provenance(spark, d):
    return A.quote_provenance(C.items(spark, d), C.posts(spark, d), C.comments(spark, d))


def _number(id: str) -> str:
    return f"(cast(substring({id}, 2) as bigint) div 20)"


def _spiking(items: DataFrame) -> DataFrame:
    """Three quarters of the rows in the newest of five weeks."""
    week = F.expr(f"if(score_at_capture % 4 <> 0, '2024-W05', concat('2024-W0', 1 + {_number('id')} % 4))")
    return S.spikes(items.withColumn("week", week))


def _clusters(spark, d):
    groups = spark.range(7).select(
        F.concat(F.lit("group "), "id").alias("canonical"),
        F.expr("transform(sequence(0, 13 - cast(id as int)), i -> cast(if(i = 2, 9000, id + 7 * i) as int))").alias("members"),
    )
    return S.clustered_features(C.items(spark, d), groups)


def _saved(spark, d):
    rows = C.posts(spark, d).drop("flair")
    made = rows.where(f"{_number('row_key')} % 31 <> 0 and {_number('row_key')} % 5 = 0").select("subreddit", "row_key", "analysis_json")
    stored = rows.where("analyzed").withColumns({"analyzed": F.lit(False), "analysis_json": F.lit(None).cast("string")})
    saved = R.save_analysis(stored, made, 4)
    return saved.groupBy("analyzed", "stance").agg(
        _n(), F.sum("intensity").alias("intensity"), F.count_if("ai_related").alias("ai_related"), F.sum(F.length("topics_csv")).alias("topic_chars"),
        F.max("schema_version").alias("schema_version"),
    )


def _tags_saved(spark, d):
    rows = C.posts(spark, d)
    changed, _ = J.retag(rows, body=None)
    saved = R.save_tags(rows, changed)
    return saved.groupBy(
        F.coalesce("content_class", F.lit("-")).alias("content_class"), F.coalesce("content_class_reason", F.lit("-")).alias("reason"),
    ).agg(_n())


def _missing(spark, d):
    raw = C.posts(spark, d).where(f"{_number('row_key')} % 7 <> 0").select("subreddit", "row_key")
    return A.missing_bodies(C.items(spark, d), raw)


def _dry_run(spark, d):
    parents = C.items(spark, d).select(F.col("id").alias("row_key"), "ai_related")
    return E.comment_corpus(C.comments(spark, d), parents)


def _export(spark, d):
    return E.export_rows(C.posts(spark, d)).select(
        *[c for c in E.export_rows(C.posts(spark, d)).columns if c != "analysis"], F.col("analysis").isNotNull().alias("parses"),
        F.get_json_object("analysis", "$.week").alias("week"),
    )


def _keys(spark, d):
    rows = C.posts(spark, d).select("kind", "row_key").unionByName(C.comments(spark, d).select("kind", "row_key"))
    again = X.row_key(F.col("kind"), X.id_of_row_key(F.col("row_key")))
    return rows.groupBy("kind").agg(_n(), F.count_if(again == F.col("row_key")).alias("round_trips"))


def _chunked(spark, d):
    rows = read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("c", X.chunks(F.col("text"), 1000))
    return rows.select(
        "doc_id", F.size("c").cast("long").alias("n_chunks"), F.length(F.element_at("c", -1)).cast("long").alias("last_chars"),
        (F.array_join("c", "") == F.col("text")).alias("whole"),
    )


def _shrunk(spark, d):
    fields = F.create_map(
        F.lit("title"), F.substring(F.substring_index("text", "\n", 1), 1, 200), F.lit("body"), F.col("text"), F.lit("lang"), F.col("lang"),
    )
    rows = read(spark, d, "documents").select("doc_id", X.shrink_fields(fields, 2000).alias("s"))
    return rows.select("doc_id", F.array_join(F.array_sort(F.map_keys("s.kept")), ",").alias("kept"), F.array_join("s.dropped", ",").alias("dropped"))


def _similar(spark, d):
    vectors = read(spark, d, "embeddings").select(
        F.concat(F.lit("d"), "vec_id").alias("id"), X.l2_normalize(F.col("embedding").cast("array<double>")).alias("emb"),
    )
    target = vectors.where("id = 'd0'").first()["emb"]  # one vector, as a question's would be
    return E.ask_rows(C.items(spark, d).join(vectors, "id"), target, ai_only=True, n=50).select("id", F.round("similarity", 5).alias("similarity"))


def _gate(spark, d):
    parents = C.items(spark, d).select(F.col("id").alias("row_key"), "ai_related")
    return K.comment_gate(C.comments(spark, d), parents).groupBy("reason", "selected").agg(_n())


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4()}"


def _in_halves(name: str) -> Query:
    """The section of two halves of the days, one of them refreshed twice."""
    def run(spark, d):
        states = {name: (STATES | cohort_states(S.frame_of(C.SUB_TAGS, C.STREAM_KINDS)))[name]}
        items, even = kept(C.items(spark, d)), F.expr("created_utc div 86400") % 2 == 0
        partials = Partials(spark, _folder(spark), states)
        for half in (even, ~even, even):
            partials.refresh(items.where(half))
        forget(items)
        return partials.table(name)

    return run


def _three_batches(rows: DataFrame) -> list[DataFrame]:
    return [rows.where(f"{_number('row_key')} % 3 = {b}") for b in range(3)]


def _repeats(spark, d):
    """Reasons after three batches, the second of which came twice, as their changes add up."""
    counts = RepeatCounts(spark, _folder(spark), FEW)
    batches, tags = _three_batches(C.posts(spark, d)), None
    for number, batch in enumerate((batches[0], batches[1], batches[1], batches[2])):
        number = max(0, number - 1) if number > 1 else number
        counts.add(number, batch)
        new = cut(counts.changed(number))
        tags = new if tags is None else new.unionByName(tags.join(new, ["subreddit", "row_key"], "left_anti"))
    return tags.groupBy(F.col("content_class_reason").alias("reason")).agg(_n())


def _merged(put, changes: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame], DataFrame]:
    """The stored table after a merge of its changed rows."""
    def run(spark, rows):
        table = PartitionedTable(spark, _folder(spark))
        table.write(E.dated(rows))
        table.merge(E.dated(changes(rows)), put)
        return table.read()

    return run


def _analysis_merged(spark, d):
    rows = C.posts(spark, d).drop("flair")
    stored = rows.where("analyzed").withColumns({"analyzed": F.lit(False), "analysis_json": F.lit(None).cast("string")})
    chosen = rows.where(f"analyzed and {_number('row_key')} % 31 <> 0 and {_number('row_key')} % 5 = 0").select("subreddit", "row_key", "created_utc", "analysis_json")
    saved = _merged(lambda old, new: R.save_analysis(old, new.drop("created_utc"), 4), lambda _: chosen)(spark, stored)
    return saved.groupBy("analyzed", "stance").agg(
        _n(), F.sum("intensity").alias("intensity"), F.count_if("ai_related").alias("ai_related"), F.sum(F.length("topics_csv")).alias("topic_chars"),
        F.max("schema_version").alias("schema_version"),
    )


def _tags_merged(spark, d):
    saved = _merged(R.save_tags, lambda rows: J.retag(rows, body=None)[0])(spark, C.posts(spark, d))
    return saved.groupBy(
        F.coalesce("content_class", F.lit("-")).alias("content_class"), F.coalesce("content_class_reason", F.lit("-")).alias("reason"),
    ).agg(_n())


def _ingested(spark, d):
    """Rows by community and day after three batches: each key once, though it comes again and moves over midnight."""
    rows, store = C.posts(spark, d).select("subreddit", "row_key", "kind", "created_utc", "title"), _folder(spark)
    moved = rows.withColumn("created_utc", F.col("created_utc") - 86400).withColumn("title", F.lit("older"))
    for batch in (_three_batches(rows)[0], rows.unionByName(moved), moved):
        I._appended(cut(batch), store)
    found, marks = spark.read.parquet(store), I.marks_of(spark, store).read()
    days = found.groupBy("subreddit", "day").agg(_n(), F.count_if(F.col("title") == "older").alias("older"))
    return days.join(marks.select("subreddit", "watermark"), "subreddit").select("subreddit", F.col("day").cast("string").alias("day"), "n", "older", "watermark")


def _admitted_stream(spark, d):
    """Tickets of each community and day, 5 a day, over a stream of requests for all rows at their own times."""
    rows, place = C.posts(spark, d), _folder(spark)
    asks = rows.select("row_key", "subreddit", "created_utc", F.timestamp_seconds("created_utc").alias("asked_at"))
    asks.write.parquet(f"{place}/in")  # all files are one batch, as no trigger is limited
    given = spark.readStream.schema(asks.schema).parquet(f"{place}/in")
    rows = admission.admitted(given, lambda _: 5, F.col("subreddit"))
    admission.write_batches(rows, f"{place}/out", f"{place}/check")
    out = read_or_none(spark, f"{place}/out", admission.OUTPUT)
    found = out if out is not None else spark.createDataFrame([], admission.OUTPUT)
    return found.groupBy("lane", F.col("day").cast("string").alias("day")).agg(_n(), F.max("ticket").alias("last_ticket"))


def _cells(spark, d):
    vectors = read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("emb"))
    target = vectors.where("id = 0").first()["emb"]  # one vector, as a question's would be
    found = VectorIndex(spark, _folder(spark)).build(vectors).search(target, 100, probes=2, exact=True)
    return found.select(F.col("id").alias("vec_id"), F.round("similarity", 5).alias("similarity"))


QUERIES: dict[str, Query] = {
    "normalize_hash": lambda s, d: read_texts(s, d, "documents").select(
        "doc_id", X.hash_if_eligible(F.col("text"), 120).alias("hash"), F.length(X.normalize(F.col("text"))).cast("long").alias("n_normalized"),
    ),
    "week_key_counts": lambda s, d: read(s, d, "events").groupBy(X.week_key(F.unix_timestamp("ts")).alias("week")).agg(_n()),
    "sub_mentions": _sub_mentions,
    "ai_prefilter": lambda s, d: read_texts(s, d, "conversations").groupBy("role").agg(F.count_if(X.mentions_ai(F.col("text"))).alias("n_hit"), _n()),
    "non_english_by_lang": lambda s, d: read_texts(s, d, "documents").groupBy("lang").agg(
        _n(), F.count_if(X.looks_non_english(F.col("text"))).alias("non_english"),
    ),
    "empty_or_removed": lambda s, d: C.posts(s, d).groupBy("subreddit").agg(F.count_if(X.is_empty_or_removed(F.col("body"))).alias("n")),
    "embedding_cosine_top": _cosine,
    "vector_base64": _base64,
    "parse_skipped": lambda s, d: R.parse_rows(C.posts(s, d).where("analyzed")).groupBy("valid").agg(_n()),
    "meta_counts": _items(S.meta),
    "meta_lists": _items(_lists),
    "content_class_counts": _items(S.non_human_reasons),
    "classify_with_bodies": lambda s, d: K.classify_bodies(C.posts(s, d), FEW).groupBy(F.col("content_class_reason").alias("reason")).agg(_n()),
    "heatmap_topic_week": _items(S.heatmap_weeks),
    "heatmap_sub_topic": _items(S.heatmap_subs),
    "stance_by_week": _items(S.stance_by_week),
    "dist_stance": _items(lambda i: S.distribution(i, "stance")),
    "dist_experience": _items(lambda i: S.distribution(i, "experience")),
    "dist_source_stance": _items(S.source_stance),
    "dist_topics": _items(S.topic_totals),
    "dist_tools_top": _items(S.tool_totals),
    "dist_pains_top": _items(S.pain_totals),
    "minbar_baseline": _items(S.baseline_totals),
    "minbar_dealbreakers": _several(S.dealbreakers, "deal_breakers"),
    "minbar_kinds": _items(S.dealbreaker_kinds),
    "trust_board": _several(S.trust_board, "trust_signals"),
    "features_board": _items(S.feature_board),
    "features_clustered": _clusters,
    "competitors_board": _items(S.competitors),
    "switching_moments": _items(S.switching_moments),
    "recurrence": _items(S.recurrence),
    "salience_rows": _several(S.salience, "topics", "pain_points"),
    "quotes_top": _several(S.quotes, "topics", "pain_points", "quote", "stance", "experience", "permalink", "title", "week", "kind"),
    "persona_sample": _several(S.persona_sample, "topics", "pain_points", "stance", "experience", "summary", "quote"),
    "resonance_top": _several(
        S.resonance, "topics", "pain_points", "features", "trust_signals", "quote", "title", "permalink", "kind", "score_at_capture", "stance", "experience", "week",
    ),
    "topic_spikes": _several(_spiking, "topics", "score_at_capture", "week"),
    "discovery_candidates": lambda s, d: S.discovery(C.items(s, d), C.comments(s, d).select("subreddit", "sub_mentions"), ["sub1", "sub2"]),
    "rules_by_sub": _items(S.rules),
    "rules_samples": _items(S.rule_samples),
    "cohort_by_frame": _framed(S.cohort),
    "cohort_basis_counts": _framed(S.cohort_basis),
    "comment_stance_mix": _framed(S.comment_mix),
    "author_modal_stance": lambda s, d: S.modal_stance(S.human_ai(C.items(s, d)).withColumn("frame", S.frame_of(C.SUB_TAGS, C.STREAM_KINDS))),
    "audit_author_top20": _items(A.top_authors),
    "audit_author_concentration": _items(A.author_concentration),
    "audit_sub_concentration": _items(lambda i: A.sub_concentration(i, C.SUB_TAGS)),
    "audit_week_spikes": _items(A.week_concentration),
    "audit_stance_coherence": _items(A.stance_coherence),
    "audit_detection_coverage": _items(A.detection_coverage),
    "audit_flair": _items(A.flairs),
    "audit_critique_sample": _items(A.critique_sample),
    "audit_body_stats": lambda s, d: A.body_stats(C.posts(s, d)),
    "audit_duplicates": lambda s, d: A.duplicate_summary(C.posts(s, d)),
    "audit_top_duplicates": lambda s, d: A.top_duplicates(C.posts(s, d)),
    "audit_missing_bodies": _missing,
    "audit_quote_provenance": lambda s, d: A.quote_buckets(_provenance(s, d)),
    "audit_quote_sample": lambda s, d: A.quote_sample(_provenance(s, d)),
    "contamination_by_sub": lambda s, d: A.contamination(C.items(s, d), C.comments(s, d)),
    "retag_report": lambda s, d: J.retag(C.posts(s, d), body=None)[1],
    "retag_saved": _tags_saved,
    "registry_hashes": _registry,
    "registry_published": lambda s, d: K.registry_of(C.items(s, d), FEW),
    "comment_filter_reasons": _filtered,
    "comment_policy_dry_run": _gate,
    "comment_corpus": _dry_run,
    "comments_first20": lambda s, d: R.first_replies(C.comments(s, d)).select("link_id", "row_key", F.col("position").cast("long").alias("position")),
    "ingest_dedupe": _new_rows,
    "upsert_merge": _upsert,
    "analysis_saved": _saved,
    "backfill_watermarks": lambda s, d: I.watermarks(C.posts(s, d)),
    "daily_cap_admission": lambda s, d: K.admit_under_cap(C.posts(s, d).where("not analyzed"), 20, 5).select("row_key", "created_utc"),
    "ask_recency_top": lambda s, d: E.ask_rows(C.items(s, d), ai_only=True, stance="wary").select("id", "created_utc", "stance"),
    "reanalyze_selection": lambda s, d: E.reanalyze_selection(
        C.posts(s, d).where("analyzed"), sub="src5", below_version=4, limit=100,
    ).select("row_key"),
    "health_counts": lambda s, d: E.health(C.posts(s, d), C.comments(s, d)),
    "registry_summary": lambda s, d: K.registry_summary(_registry(s, d)),
    "filtered_last_day": lambda s, d: K.filtered_last_day(
        K.filter_tally(K.filter_comments(C.comments(s, d)), F.date_from_unix_date(F.col("turn").cast("int"))), F.to_date(F.lit("1970-01-06")),
    ),
    "keyset_page": lambda s, d: R.page_after(C.posts(s, d), ["subreddit", "row_key"], ("src3", "d5"), 50).select("subreddit", "row_key"),
    "row_keys": _keys,
    "payload_chunks": _chunked,
    "payload_shrunk": _shrunk,
    "ask_similarity_top": _similar,
    "export_rows": _export,
    "stance_by_week_in_halves": _in_halves("stance_by_week"),
    "heatmap_sub_topic_in_halves": _in_halves("heatmap_subs"),
    "recurrence_in_halves": _in_halves("recurrence"),
    "rules_by_sub_in_halves": _in_halves("rules"),
    "repeats_in_batches": _repeats,
    "analysis_merged": _analysis_merged,
    "tags_merged": _tags_merged,
    "ingested_rows": _ingested,
    "admitted_stream": _admitted_stream,
    "vector_cells_top": _cells,
    "snapshot_headline": _items(E.snapshot),
}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["cohort_by_frame"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
