"""A discussion corpus derived from the data tables by fixed arithmetic (the offline rule analyzer).

Documents are submissions, conversations are comments under the first documents. Attributes come from the
event with the document's number and from ``doc_id div 20``, since ``source`` is already ``doc_id % 20``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope import vocabulary as V
from agorascope.functions import text as X
from agorascope.operators.classify import classify_untagged, hashed
from agorascope.operators.rows import parse_rows
from agorascope.session import read, read_texts

FEATURES = (
    "proof of work", "continuity checker", "offline mode", "control over the ai", "dark mode", "Word export", "disclosure badge", "timeline view",
    "no training promise", "fast search",
)
#: Tags of communities, and kinds of streams, as the settings would hold them.
SUB_TAGS = {"src0": "enclave-pro", "src1": "enclave-pro", "src2": "enclave-anti", "src3": "enclave-satire"}
STREAM_KINDS = {"src18": "topic", "src19": "community"}


def _of(values, index: str) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast(1 + pmod({index}, {len(values)}) as int))"


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows of submissions, analysis as JSON text; some of it is cut off, as after a failed write."""
    # What is made of a text is made before the joins, so that texts go through them only where a body is asked for; the
    # joins are by the rows' own key, so that a later join by it need not shuffle the bodies again.
    key = lambda number: F.concat(F.lit("d"), number).alias("row_key")
    docs = read_texts(spark, sf_dir, "documents").select(
        key("doc_id"), "doc_id", "text", "source", F.substring(F.substring_index("text", "\n", 1), 1, 200).alias("title"), F.substring("text", 5, 60).alias("start"),
    )
    events = read(spark, sf_dir, "events").select(
        key("event_id"), "user_id", "ts", F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("k"),
    )
    labels = read(spark, sf_dir, "labels").groupBy(key("doc_id")).agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    base = docs.join(events, "row_key").join(labels, "row_key", "left").select(
        "*", F.expr("doc_id div 20").alias("q"), F.coalesce("user_id", F.lit(0)).alias("u"), F.unix_timestamp("ts").alias("created_utc"),
    )
    stance = _of(V.STANCES, "k + q")
    analysis = {
        "week": X.week_key(F.col("created_utc")),
        "ai_related": F.expr("coalesce(quality = 1, false) or k % 3 = 0"),
        "stance_on_ai": F.expr(stance),
        "persona": F.struct(F.expr(_of(V.EXPERIENCE, "u")).alias("experience"), F.lit("finish a draft").alias("goal")),
        "stance_basis": F.expr(f"if({stance} in ('hostile', 'wary', 'conflicted'), array({_of(V.STANCE_BASIS, 'k + q')}, {_of(V.STANCE_BASIS, 'u')}), array())"),
        "stance_intensity": F.expr("cast(pmod(q + k, 4) as int)"),
        "comment_stance_mix": F.expr("if(k % 5 = 0, map('hostile', cast(k % 4 as int), 'curious', cast(q % 3 as int)), null)"),
        "topics": F.expr(f"concat(array({_of([t for t, _ in V.TOPICS], 'k * 7 + q')}, {_of([t for t, _ in V.TOPICS], 'u + 3 * q')}), if(k % 4 = 0, array('unknown-topic'), array()))"),
        "pain_points": F.expr("concat(array(concat('Pain ', k % 13)), if(k % 2 = 0, array(concat(' pain ', q % 11, ' ')), array()))"),
        "expected_baseline": F.expr("array(concat('Baseline ', u % 9))"),
        "deal_breakers": F.expr(f"if(k % 2 = 1, array(named_struct('item', if(k % 3 = 0, concat('ITEM ', q % 8), concat('item ', q % 8)), 'kind', {_of(V.DEALBREAKER_KINDS, 'k')}, 'quote', concat('deal quote number ', q, ' of them'))), array())"),
        "trust_signals": F.expr("array(named_struct('signal', concat('Signal ', q % 7), 'direction', element_at(array('builds', 'breaks', 'sideways'), cast(1 + k % 3 as int)), 'quote', concat('trust quote ', q % 5)))"),
        "feature_requests": F.expr(f"if(q % 2 = 0, array(named_struct('feature', {_of(FEATURES, 'k')}, 'ai_related', u % 2 = 0, 'quote', concat('want ', q))), array())"),
        "tools_mentioned": F.expr("array(named_struct('tool', concat(' Tool', u % 12, ' '), 'sentiment', element_at(array('positive', 'negative', 'mixed', 'neutral', 'odd'), cast(1 + k % 5 as int)), 'switching', q % 6 = 0, 'context', concat('context ', q)))"),
        "notable_quote": F.expr("case q % 3 when 0 then start when 1 then concat('no such words are in the text at all ', q) else '' end"),
        "summary": F.concat(F.lit("summary "), "doc_id"),
    }
    json = F.to_json(F.struct(*[c.alias(k) for k, c in analysis.items()]))
    return base.select(
        F.when(F.col("source").isin(*STREAM_KINDS), "bluesky").otherwise("reddit").alias("source"),
        F.lit("post").alias("kind"), F.col("source").alias("subreddit"), "row_key",
        "title", F.col("text").alias("body"),
        F.expr("case when q % 17 = 0 then 'AutoModerator' when u % 50 = 0 then '[deleted]' else concat('user', u) end").alias("author"),
        F.concat(
            F.lit("/r/"), "source", F.lit("/"), "doc_id",
        ).alias("permalink"), F.col("k").cast("int").alias("score"), F.col("u").cast("int").alias("num_comments"), "created_utc",
        F.expr("if(q % 23 = 0, 'moderator', null)").alias("distinguished"), F.expr("q % 29 = 0").alias("stickied"),
        F.expr("element_at(array(null, 'Critique', 'Discussion', 'Feedback request', 'News'), cast(1 + k % 5 as int))").alias("flair"),
        F.lit(None).cast("string").alias("link_id"), F.lit(None).cast("string").alias("parent_id"),
        F.expr("if(q % 4 = 0, array(concat('sub', k % 15), lower(source)), if(q % 9 = 0, array('askreddit'), array()))").alias("sub_mentions"),
        F.lit(None).cast("string").alias("content_class"), F.lit(None).cast("string").alias("content_class_reason"),
        F.expr("q % 37 <> 0").alias("analyzed"), F.lit(V.SCHEMA_VERSION).alias("schema_version"),
        F.when(F.expr("q % 31 = 0"), F.substring(json, 1, 40)).otherwise(json).alias("analysis_json"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows of comments, one for each conversation turn; each third is a reply to the turn before."""
    turns = read_texts(spark, sf_dir, "conversations")
    return turns.select(
        F.lit("comment").alias("kind"), F.concat(
            F.lit("c_"), "conv_id", F.lit("_"), "turn",
        ).alias("row_key"), F.concat(F.lit("d"), "conv_id").alias("link_id"),
        F.expr("concat('src', conv_id % 20)").alias("subreddit"), F.col("text").alias("body"),
        F.expr("case role when 'assistant' then 'AutoModerator' when 'system' then 'mod' else concat('user', conv_id % 40) end").alias("author"),
        (F.col("role") == "system").alias("stickied"), F.lit(None).cast("string").alias("distinguished"), F.col("turn").alias("created_utc"),
        F.length("text").cast("long").alias("body_chars"), X.mentions_ai(F.col("text")).alias("ai_prefilter_hit"), "conv_id", "turn",
        F.expr("if(turn % 3 = 2, concat(conv_id, '_', turn - 1), null)").alias("parent_id"),
        F.expr("if(turn % 2 = 0, array(concat('sub', conv_id % 20), concat('src', conv_id % 20)), array())").alias("sub_mentions"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified items of the analyzed submissions, which every section reads. Nothing is written: a section that uses
    them once parses only the fields that it needs."""
    return classify_untagged(hashed(parse_rows(posts(spark, sf_dir).where("analyzed")).where("valid").drop("valid")))
