"""Stored rows: strict parsing of the analysis, merging, keys, shrinking for export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.functions import text

ANALYSIS = (
    "week: string, ai_related: boolean, stance_on_ai: string, persona: struct<experience: string, goal: string>, stance_basis: array<string>, stance_intensity: int, "
    "comment_stance_mix: map<string, int>, topics: array<string>, pain_points: array<string>, expected_baseline: array<string>, "
    "deal_breakers: array<struct<item: string, kind: string, quote: string>>, trust_signals: array<struct<signal: string, direction: string, quote: string>>, "
    "feature_requests: array<struct<feature: string, ai_related: boolean, quote: string>>, ethics_concerns: array<string>, notable_quote: string, summary: string"
)
TOOL = "struct<tool: string, sentiment: string, switching: boolean, context: string>"


def parse_rows(rows: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Items with defaults filled in, and ``valid``: the analysis is exactly one JSON object.

    A list around the text makes trailing text, a second value or a cut object malformed. Old rows
    name tools as bare strings; these read as neutral mentions. ``carried`` columns go along as they are.
    """
    list_of_one = F.from_json(
        F.concat(F.lit("["), "analysis_json", F.lit("]")), f"array<struct<{ANALYSIS}, tools_mentioned: variant>>", {"allowSingleQuotes": "false"},
    )
    # Always true: filters on what is parsed aren't moved below the parsing, where it would be done again for each.
    list_of_one = F.when(F.monotonically_increasing_id() >= 0, list_of_one)
    parsed = rows.withColumn("list", list_of_one).withColumn("a", F.get("list", F.lit(0))).withColumn(
        "tool_list", F.try_variant_get("a.tools_mentioned", "$", "array<variant>"),
    )
    empty = lambda kind: F.array().cast(kind)
    field = lambda t, k, kind="string": F.try_variant_get(t, f"$.{k}", kind)
    tools = F.transform(
        "tool_list",
        lambda t: F.struct(
            F.coalesce(field(t, "tool"), F.try_variant_get(t, "$", "string")).alias("tool"),
            F.coalesce(field(t, "sentiment"), F.lit("neutral")).alias("sentiment"),
            F.coalesce(field(t, "switching", "boolean"), F.lit(False)).alias("switching"),
            F.coalesce(field(t, "context"), F.lit("")).alias("context"),
        ),
    )
    return parsed.select(
        F.coalesce("source", F.lit("reddit")).alias("source"), F.when(F.col("kind") == "comment", "comment").otherwise("post").alias("kind"),
        F.coalesce(
            "link_id", "row_key",
        ).alias("thread_id"), "parent_id", "subreddit", F.col("row_key").alias("id"), "title", F.coalesce("author", F.lit("")).alias("author"), "permalink",
        F.coalesce("score", F.lit(0)).alias("score_at_capture"), F.coalesce(
            "num_comments", F.lit(0),
        ).alias("num_comments_at_capture"), "created_utc", "content_class",
        F.coalesce(
            "content_class_reason", F.lit(""),
        ).alias("content_class_reason"), "distinguished", F.coalesce("stickied", F.lit(False)).alias("stickied"), "flair", "sub_mentions",
        F.coalesce("a.week", F.lit("")).alias("week"), F.coalesce("a.ai_related", F.lit(False)).alias("ai_related"), F.coalesce(
            "a.stance_on_ai", F.lit("na"),
        ).alias("stance"),
        F.coalesce(
            "a.stance_basis", empty("array<string>"),
        ).alias("stance_basis"), F.coalesce("a.stance_intensity", F.lit(0)).alias("intensity"), F.col("a.comment_stance_mix").alias("comment_mix"),
        F.coalesce(
            "a.persona.experience", F.lit("unknown"),
        ).alias("experience"), F.coalesce("a.topics", empty("array<string>")).alias("topics"), F.coalesce("a.pain_points", empty("array<string>")).alias("pain_points"),
        F.coalesce("a.expected_baseline", empty("array<string>")).alias("expected_baseline"), F.coalesce(
            "a.deal_breakers", empty("array<struct<item:string,kind:string,quote:string>>"),
        ).alias("deal_breakers"),
        F.coalesce("a.trust_signals", empty("array<struct<signal:string,direction:string,quote:string>>")).alias("trust_signals"), F.coalesce(
            "a.feature_requests", empty("array<struct<feature:string,ai_related:boolean,quote:string>>"),
        ).alias("features"),
        F.coalesce(
            tools, empty(f"array<{TOOL}>"),
        ).alias("tools"), F.coalesce("a.notable_quote", F.lit("")).alias("quote"), F.coalesce("a.summary", F.lit("")).alias("summary"),
        (F.coalesce(F.size("list") == 1, F.lit(False)) & F.col("a").isNotNull()).alias("valid"), *carried,
    )


def merge_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Column merge by key: a new row's values win where they aren't null, and ``is_new`` tells rows that were not there.

    Columns that only one side has are kept, so a re-ingested row never loses its analysis.
    """
    columns = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    pick = lambda c: F.coalesce(*[F.col(f"{side}.{c}") for side, df in (("n", new), ("o", old)) if c in df.columns]).alias(c)
    return o.join(n, keys, "full_outer").select(*keys, *[pick(c) for c in columns], F.col("_old").isNull().alias("is_new"))


def admit(stored: DataFrame, incoming: DataFrame, keys: list[str], newest: str = "created_utc") -> DataFrame:
    """Incoming rows, one for each key, that are not stored yet.

    Of rows with equal keys the one with the greatest ``newest`` is taken, then the one whose other columns have
    the greatest hash, so which one it is never depends on the run.
    """
    others = [c for c in incoming.columns if c not in keys]
    order = F.struct(*([F.col(newest)] if newest in others else []), F.xxhash64(*others, F.lit(0)))
    one = incoming.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_row")).select(
        *keys, "_row.*",
    ) if others else incoming.select(*keys).distinct()
    return one.join(stored.select(*keys), keys, "left_anti").select(*incoming.columns)


def first_replies(comments: DataFrame, most: int = 20) -> DataFrame:
    """The first top-level replies of each thread in time order, never by score. A reply to a comment has its ``parent_id``."""
    order = Window.partitionBy("link_id").orderBy("created_utc", "row_key")
    return comments.where("parent_id is null").withColumn("position", F.row_number().over(order)).where(F.col("position") <= most)


def page_after(rows: DataFrame, keys: list[str], cursor: tuple | None, n: int) -> DataFrame:
    """The ``n`` rows that follow ``cursor`` in key order, so that a bounded scan goes on where it stopped; None starts it."""
    if cursor is not None:
        after = F.lit(False)
        for key, value in reversed(list(zip(keys, cursor, strict=True))):
            after = (F.col(key) > value) | ((F.col(key) == value) & after)
        rows = rows.where((F.col(keys[0]) >= cursor[0]) & after)  # the first condition by itself reaches the scan
    return rows.orderBy(*keys).limit(n)


def row_of(rows: DataFrame, subreddit: str, row_key: str) -> DataFrame:
    """The stored row with this key, if there is one; both conditions reach the scan, the first prunes folders."""
    return rows.where((F.col("subreddit") == subreddit.lower()) & (F.col("row_key") == row_key)).limit(1)


def promoted(analysis: str = "analysis_json") -> dict[str, Column]:
    """Columns of the analysis that stand beside it in the store, so that scans need not parse it."""
    a = F.from_json(analysis, f"struct<{ANALYSIS}>")
    plain = {
        "ai_related": F.coalesce(a["ai_related"], F.lit(False)), "stance": F.coalesce(a["stance_on_ai"], F.lit("na")),
        "experience": F.coalesce(a["persona"]["experience"], F.lit("unknown")),
    }
    lists = {"topics_csv": a["topics"], "stance_basis_csv": a["stance_basis"]}
    return plain | {k: F.array_join(F.coalesce(v, F.array().cast("array<string>")), ",") for k, v in lists.items()} | {
        "intensity": F.coalesce(a["stance_intensity"], F.lit(0)), "week": F.coalesce(a["week"], F.lit("")),
    }


def save_analysis(rows: DataFrame, made: DataFrame, schema_version: int, most_chars: int = 30_000) -> DataFrame:
    """The stored rows with a model's results in them. made: (subreddit, row_key, analysis_json) and what else it brings.

    A row of ``made`` is marked analyzed, its analysis stands beside its promoted columns, and an analysis of more than
    ``most_chars`` characters loses its longest fields, whose names ``analysis_truncated`` tells. Other rows and columns
    stay. A key that comes twice in ``made`` counts once, the greatest analysis.
    """
    fields = F.from_json("analysis_json", "map<string, string>")
    shrunk = text.shrink_fields(fields, most_chars)
    one = made.groupBy("subreddit", "row_key").agg(F.max_by(F.struct(*[c for c in made.columns if c not in ("subreddit", "row_key")]), "analysis_json").alias("m")).select(
        "subreddit", "row_key", "m.*",
    )
    long = F.length("analysis_json") > most_chars
    cutoff = one.withColumn("_s", F.when(long, shrunk))
    # what is dropped is cut out of the text's own values, so that the kept ones stay as they were
    kept = F.when(
        long, F.to_json(F.map_filter(F.from_json("analysis_json", "map<string, variant>"), lambda k, _: ~F.array_contains(F.col("_s.dropped"), k))),
    ).otherwise(F.col("analysis_json"))
    packed = cutoff.withColumn(
        "analysis_truncated", F.coalesce(F.array_join("_s.dropped", ","), F.lit("")),
    ).withColumn("analysis_json", kept).drop("_s")
    new = packed.withColumns(promoted() | {"analyzed": F.lit(True), "schema_version": F.lit(schema_version)})
    return merge_rows(rows, new, ["subreddit", "row_key"]).drop("is_new")


def save_tags(rows: DataFrame, tags: DataFrame) -> DataFrame:
    """The stored rows with new tags (subreddit, row_key, content_class, content_class_reason); nothing else changes, no row comes."""
    known = tags.select("subreddit", "row_key", F.col("content_class").alias("_class"), F.col("content_class_reason").alias("_reason"))
    put = {
        "content_class": F.coalesce("_class", "content_class"),
        "content_class_reason": F.when(F.col("_class").isNotNull(), F.col("_reason")).otherwise(F.col("content_class_reason")),
    }
    return rows.join(known, ["subreddit", "row_key"], "left").select(*[put.get(c, F.col(c)).alias(c) for c in rows.columns])
