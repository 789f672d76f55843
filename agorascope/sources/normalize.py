"""Raw posts and comments of the sources as rows of the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.functions import text as X

RAW_POST = "id string, subreddit string, title string, selftext string, author string, permalink string, score int, num_comments int, created_utc string, distinguished string, stickied boolean, link_flair_text string"
RAW_COMMENT = "id string, subreddit string, body string, author string, permalink string, score int, created_utc string, link_id string, parent_id string, distinguished string, stickied boolean"
RAW_STREAM = "uri string, text string, handle string, did string, like_count int, repost_count int, reply_count int, created_at string"


def epoch(value: Column) -> Column:
    """Seconds from an epoch number or an ISO time."""
    return F.coalesce(value.try_cast("double").cast("long"), F.unix_timestamp(value.try_cast("timestamp")))


def _bare(id: Column) -> Column:
    return F.regexp_replace(id, "^t[0-9]_", "")


def posts(raw: DataFrame) -> DataFrame:
    sub = F.lower("subreddit")
    return raw.select(
        F.lit("reddit").alias("source"), F.lit("post").alias("kind"), sub.alias("subreddit"), F.col("id").alias("row_key"), F.substring(
            F.coalesce("title", F.lit("")), 1, 500,
        ).alias("title"),
        F.substring(F.coalesce("selftext", F.lit("")), 1, 12000).alias("body"), F.coalesce("author", F.lit("")).alias("author"), F.coalesce(
            "permalink", F.concat(F.lit("/r/"), sub, F.lit("/comments/"), "id"),
        ).alias("permalink"),
        F.coalesce("score", F.lit(0)).alias("score"), F.coalesce(
            "num_comments", F.lit(0),
        ).alias("num_comments"), epoch(F.col("created_utc")).alias("created_utc"), "distinguished", F.coalesce("stickied", F.lit(False)).alias("stickied"), F.col("link_flair_text").alias("flair"),
    )


def comments(raw: DataFrame, body_chars: int = 3000) -> DataFrame:
    """Comments under their submission; ``parent_id`` is null for top-level ones; the title is the first line."""
    sub, link, body = F.lower("subreddit"), _bare(F.col("link_id")), F.substring(F.coalesce("body", F.lit("")), 1, body_chars)
    return raw.select(
        F.lit("reddit").alias("source"), F.lit("comment").alias("kind"), sub.alias("subreddit"), X.row_key(F.lit("comment"), F.col("id")).alias("row_key"), F.substring(
            F.substring_index(body, "\n", 1), 1, 200,
        ).alias("title"), body.alias("body"), F.coalesce("author", F.lit("")).alias("author"),
        F.coalesce(
            "permalink", F.concat(F.lit("/r/"), sub, F.lit("/comments/"), link, F.lit("/_/"), "id"),
        ).alias("permalink"), F.coalesce("score", F.lit(0)).alias("score"), epoch(F.col("created_utc")).alias("created_utc"), "distinguished", F.coalesce("stickied", F.lit(False)).alias("stickied"),
        link.alias("link_id"), F.when(
            F.startswith("parent_id", F.lit("t1_")), _bare(F.col("parent_id")),
        ).alias("parent_id"), F.length(body).cast("long").alias("body_chars"), X.mentions_ai(body).alias("ai_prefilter_hit"), X.sub_mentions(body, sub).alias("sub_mentions"),
    )


def replies(raw: DataFrame, most: int = 20, body_chars: int = 3000) -> DataFrame:
    """(link_id, replies): the first top-level replies of each thread in time order, as they are archived beside a post."""
    from agorascope.operators.rows import first_replies

    kept = first_replies(comments(raw, body_chars), most)
    each = F.struct(
        "position", F.struct(F.col("row_key").alias("id"), "author", F.col("score").alias("score_at_capture"), "created_utc", "body").alias("reply"),
    )
    return kept.groupBy("link_id").agg(F.transform(F.array_sort(F.collect_list(each)), lambda e: e["reply"]).alias("replies"))


def stream_posts(raw: DataFrame, stream: str | Column) -> DataFrame:
    """Posts of a keyword stream: the community is the stream's name, the key the author's id and the record's."""
    name = F.lower(F.lit(stream) if isinstance(stream, str) else stream)
    did, record = F.regexp_extract("uri", "^at://([^/]+)/", 1), F.regexp_extract("uri", "([^/]+)$", 1)
    text = F.coalesce("text", F.lit(""))
    return raw.select(
        F.lit("bluesky").alias("source"), F.lit("post").alias("kind"), name.alias("subreddit"), F.concat_ws(
            ".", F.regexp_replace(did, "[^A-Za-z0-9]", "_"), record,
        ).alias("row_key"), F.substring(F.substring_index(text, "\n", 1), 1, 200).alias("title"), text.alias("body"), F.coalesce("handle", F.lit("")).alias("author"),
        F.when(
            F.col("handle").isNotNull(), F.concat(F.lit("https://bsky.app/profile/"), "handle", F.lit("/post/"), record),
        ).otherwise(F.col("uri")).alias("permalink"),
        (F.coalesce("like_count", F.lit(0)) + F.coalesce("repost_count", F.lit(0))).alias("score"), F.coalesce(
            "reply_count", F.lit(0),
        ).alias("num_comments"), epoch(F.col("created_at")).alias("created_utc"),
    )
