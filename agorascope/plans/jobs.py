"""Maintenance and model jobs: retag, audit, analysis of admitted rows, synthesis with the last good result kept."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.config import Boilerplate
from agorascope.functions import text as X
from agorascope.operators import audit as A
from agorascope.operators import classify as K
from agorascope.operators import rows as R
from agorascope.operators import sections as S
from agorascope.plans.engine import analyze_pending, one_row
from agorascope.plans.states import CorruptState, States
from agorascope.session import cut


def retag(posts: DataFrame, limits: Boilerplate = Boilerplate(), body: str | None = "body") -> tuple[DataFrame, DataFrame]:
    """(changed rows with their new tag, report). The old tag goes along as a column; nothing is written and no model is called."""
    if body:
        tagged = K.classify_bodies(posts, limits, body)
    else:
        old = posts.withColumn("old_reason", F.coalesce("content_class_reason", F.lit(""))).drop("content_class", "content_class_reason")
        tagged = K.classify_rows(old, limits)
    time = ["created_utc"] if "created_utc" in tagged.columns else []
    changed = tagged.where("content_class_reason <> old_reason").select("subreddit", "row_key", *time, "content_class", "content_class_reason")
    return changed, A.retag_report(tagged)


def audit(items: DataFrame, posts: DataFrame, comments: DataFrame, tags: dict[str, str], raw: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every table of the audit. Missing tags make all communities population here; only the cohort refuses.

    With ``raw``, the keys of the raw archive, posts whose record is missing there are counted.
    """
    provenance = A.quote_provenance(items, posts, comments)
    missing = {} if raw is None else {"missing": A.missing_bodies(items, raw)}
    return missing | {
        "author_concentration": A.author_concentration(items), "top_authors": A.top_authors(items), "sub_concentration": A.sub_concentration(
            items, tags or {"": ""},
        ), "weeks": A.week_concentration(items),
        "stance_coherence": A.stance_coherence(items), "detection_coverage": A.detection_coverage(items), "flairs": A.flairs(items), "critique_sample": A.critique_sample(items),
        "bodies": A.body_stats(posts), "duplicates": A.duplicate_summary(posts), "top_duplicates": A.top_duplicates(posts), "quotes": A.quote_buckets(provenance), "quote_sample": A.quote_sample(provenance), "contamination": A.contamination(
            items, comments,
        ),
    }


def write_report(tables: dict[str, DataFrame], path: str, day: str) -> None:
    """Each table under its date, computed once, and that as the latest."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}/{day}")
        table.sparkSession.read.parquet(f"{path}/{name}/{day}").write.mode("overwrite").parquet(f"{path}/{name}/latest")


def settings_sections(
    tags: Callable[[], dict[str, str]], kinds: dict[str, str], tracked: list[str] | tuple[str, ...], comment_mentions: DataFrame | None,
) -> dict:
    """The sections that need settings. ``tags()`` is asked when the cohort is built, so a missing setting fails that alone."""
    def discovery(i: DataFrame) -> DataFrame:
        mentions = comment_mentions if comment_mentions is not None else i.limit(0).select("subreddit", "sub_mentions")
        return S.discovery(i, mentions, list(tracked))

    return {
        "cohort": {
            "frames": lambda i: S.cohort(i, tags(), kinds), "basis": lambda i: S.cohort_basis(i, tags(), kinds),
            "comment_mix": lambda i: S.comment_mix(i, tags(), kinds),
        },
        "discovery": {"candidates": discovery},
    }


def feature_section(items: DataFrame, cluster: Callable[[list[str]], list[tuple[str, list[int]]]]) -> DataFrame:
    """(canonical, n, ai_related, examples, degraded): the clusterer's board, or, if it fails, that of exact names."""
    names = [r["feature"] for r in S.feature_names(items).orderBy("member").collect()]  # at most 400
    try:
        groups = cluster(names) if names else []
    except Exception as failure:  # the model's own; the board degrades and says so
        reason = str(failure).split("\n")[0][:500]
        return S.feature_board(items).select(
            F.col("feature").alias("canonical"), "n", F.lit(None).cast("boolean").alias("ai_related"), F.lit("").alias("examples"),
            F.lit(reason).alias("degraded"),
        )
    made = items.sparkSession.createDataFrame(groups, "canonical string, members array<int>")
    return S.clustered_features(items, made).select("canonical", "n", "ai_related", "examples", F.lit(None).cast("string").alias("degraded"))


def analyze(
    pending: DataFrame, comments: DataFrame, parents: DataFrame, analyzer: Callable, schema: str, cap: int, used: int = 0,
    policy: str = "ingest-only", min_chars: int = 400, registry: DataFrame | None = None,
) -> DataFrame:
    """Model output for the rows that the gate and the day's cap admit.

    Cheap steps come first: the comment gate, then the cap, then the comment filter, and only then the
    model. Each row carries up to 20 kept comments of its thread and the communities that it names.
    """
    gated = K.comment_gate(comments, parents, policy, min_chars).where("selected").select("row_key")
    posts = pending.where("kind <> 'comment'")
    admitted = K.admit_under_cap(
        posts.unionByName(pending.where("kind = 'comment'").join(gated, "row_key", "left_semi").select(*posts.columns)), cap, used,
    )
    # only the threads of what was admitted: a few rows, however many comments there are
    admitted = cut(admitted)
    theirs = comments.join(admitted.select(F.col("row_key").alias("link_id")).distinct(), "link_id", "left_semi")
    kept = R.first_replies(K.filter_comments(theirs, registry).where("reason is null"))
    said = kept.groupBy("link_id").agg(F.array_sort(F.collect_list(F.struct("position", "body"))).alias("said")).select(
        F.col("link_id").alias("row_key"), F.expr("transform(said, s -> s.body)").alias("comments"),
    )
    rows = admitted.join(said, "row_key", "left").withColumn("comments", F.coalesce("comments", F.array().cast("array<string>")))
    rows = rows.withColumn("sub_mentions", X.sub_mentions(F.concat_ws(" ", "title", "body", F.array_join("comments", " ")), F.col("subreddit")))
    return analyze_pending(rows, analyzer, schema)


def synthesize(spark: SparkSession, name: str, path: str, build: Callable[[], dict]) -> dict:
    """A model-made section. If the model fails, the last good one with ``_stale``; a good one is kept for later.

    If what was kept is damaged, there is nothing to go on with, and ``_corrupt`` says so: it is not taken for a first run.
    The next good one takes its place.
    """
    states = States(spark, path)
    try:
        made = build()
    except Exception as failure:
        try:
            last = states.load(name) or {}
        except CorruptState as damage:
            last = {"_corrupt": str(damage)}
        return last | {"_stale": True, "_staleReason": str(failure)}
    states.save(name, made)
    return made


def made(spark: SparkSession, section: str, evidence: Callable[[DataFrame], tuple], model: Callable[..., dict]) -> Callable:
    """A table (value, stale, stale_reason) of one row: what the model makes of the evidence, or the last good value if it fails."""
    def build(items: DataFrame, read: Callable) -> DataFrame:
        try:
            return one_row(spark, model(*evidence(items)), None)
        except Exception as failure:
            last = read(section, "made")
            row = last.first() if last is not None else None
            return one_row(spark, json.loads(row["value"]) if row else {}, str(failure).split("\n")[0][:500])

    return build


def persona_evidence(items: DataFrame, n: int = 200) -> tuple[list, dict]:
    sample = [r.asDict() for r in S.persona_sample(items, n).collect()]
    return sample, {c: {r[0]: r[1] for r in S.distribution(items, c).collect()} for c in ("stance", "experience")}


def brief_evidence(items: DataFrame) -> tuple[dict]:
    boards = {
        "baseline": S.baseline_totals(items, 25), "dealbreakers": S.dealbreakers(items, 20), "trust": S.trust_board(items),
        "features": S.feature_board(items), "tools": S.tool_totals(items, 12), "pains": S.pain_totals(items, 15), "quotes": S.quotes(items, 120),
    }
    return ({k: [r.asDict() for r in b.collect()] for k, b in boards.items()},)


def personas(spark: SparkSession, items: DataFrame, path: str, model: Callable[[list, dict], dict], n: int = 200) -> dict:
    """Personas from the top of the salience order and the distributions."""
    return synthesize(spark, "personas", path, lambda: model(*persona_evidence(items, n)))


def brief(spark: SparkSession, items: DataFrame, path: str, model: Callable[[dict], dict]) -> dict:
    """A strategy brief from an evidence pack of bounded boards."""
    return synthesize(spark, "brief", path, lambda: model(*brief_evidence(items)))
