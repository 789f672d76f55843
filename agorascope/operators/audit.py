"""Corpus audit in single distributed passes: concentration, coverage, duplicates, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.functions import text as X
from agorascope.operators.classify import filter_comments
from agorascope.operators.quotes import contained
from agorascope.operators.sections import share
from agorascope.session import cut
from agorascope.vocabulary import FICTION_HEAVY


def _count() -> Column:
    return F.count(F.lit(1))


def authors(items: DataFrame) -> DataFrame:
    return items.groupBy(F.when(F.col("author") == "", "[unknown]").otherwise(F.col("author")).alias("author")).agg(
        _count().alias("posts"), F.count_if("ai_related").alias("ai_posts"), F.countDistinct("subreddit").alias("subs"),
        F.min(F.struct("subreddit", "id")).alias("seen"),
    )


def top_authors(items: DataFrame, n: int = 20) -> DataFrame:
    return authors(items).orderBy(F.desc("ai_posts"), F.desc("posts"), "author").limit(n).drop("seen")


def author_concentration(items: DataFrame) -> DataFrame:
    """Shares of AI posts by the top 1 and 10 percent of authors, one author at least.

    Authors are ranked through the histogram of their AI posts, so no task sees all of them: the top
    share is the sum over whole counts above the cut and the part of the count at the cut.
    """
    counts = authors(items).groupBy("ai_posts").agg(_count().alias("n"))
    above = Window.orderBy(F.desc("ai_posts")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.select(
        "*", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"), counts.agg(F.sum("n")).scalar().alias("total_authors"),
        counts.agg(F.sum(F.col("n") * F.col("ai_posts"))).scalar().alias("total_ai"),
    )
    def top(p):
        cut = F.greatest(F.lit(1), F.ceil(F.col("total_authors") * p))
        return F.sum(F.col("ai_posts") * F.greatest(F.lit(0), F.least(F.col("n"), cut - F.col("before"))))
    return ranked.groupBy("total_authors", "total_ai").agg(top(0.01).alias("a"), top(0.1).alias("b")).select(
        "total_authors", "total_ai", share(F.col("a"), F.col("total_ai")).alias("top1_share"),
        share(F.col("b"), F.col("total_ai")).alias("top10_share"),
    )


def sub_concentration(items: DataFrame, tags: dict[str, str]) -> DataFrame:
    """AI posts by community and tag; a tag that begins with ``enclave`` counts as one, in any case of the name."""
    table = F.create_map(*[F.lit(x) for k, v in tags.items() for x in (k.lower(), v)])
    rows = items.where("ai_related").groupBy("subreddit").agg(_count().alias("n")).withColumn(
        "tag", F.coalesce(F.element_at(table, F.lower("subreddit")), F.lit("population")),
    )
    enclave = rows.agg(share(F.sum(F.when(F.col("tag").startswith("enclave"), F.col("n")).otherwise(0)), F.sum("n"))).scalar()
    return rows.select("subreddit", "tag", "n", enclave.alias("enclave_share"))


def week_concentration(items: DataFrame) -> DataFrame:
    """Weekly AI posts with the exact median, spikes above three times it, and weeks before 2019."""
    rows = items.where("ai_related and week <> ''").groupBy("week").agg(_count().alias("n"))
    return rows.select("week", "n", rows.agg(F.median("n")).scalar().alias("median")).select(
        "week", "n", "median", ((F.col("median") > 0) & (F.col("n") > 3 * F.col("median"))).alias("spike"),
        (F.col("week") < "2019-W01").alias("stray"),
    )


def stance_coherence(items: DataFrame) -> DataFrame:
    strong = F.col("stance") != "na"
    return items.agg(
        F.count_if(strong & ~F.col("ai_related")).alias("strong_not_ai"), F.count_if(F.col("ai_related") & ~strong).alias("ai_no_stance"),
        _count().alias("total"),
    )


def detection_coverage(items: DataFrame) -> DataFrame:
    n = lambda k: F.count_if(F.coalesce("content_class", F.lit("human")) == k).alias(k)
    return items.groupBy("subreddit").agg(_count().alias("total"), n("bot"), n("boilerplate"), n("human")).withColumn(
        "zero_detection", (F.col("bot") == 0) & (F.col("boilerplate") == 0),
    )


def flairs(items: DataFrame) -> DataFrame:
    critique = F.lower("subreddit").isin(*FICTION_HEAVY) | X.critique_flaired(F.col("flair"))
    return items.groupBy(
        "subreddit", F.coalesce(F.when(F.col("flair") != "", F.col("flair")), F.lit("(none)")).alias("flair"),
    ).agg(_count().alias("n"), F.count_if(critique).alias("critique"))


def critique_sample(items: DataFrame, n: int = 30) -> DataFrame:
    rows = items.where(F.lower("subreddit").isin(*FICTION_HEAVY) | X.critique_flaired(F.col("flair")))
    return rows.orderBy("subreddit", "id").limit(n).select("subreddit", "id", "flair", "stance")


def body_stats(rows: DataFrame, key: str = "subreddit") -> DataFrame:
    """Length sums, and empty, removed or non-English bodies, by community."""
    return rows.groupBy(key).agg(
        _count().alias("n"), F.sum(X.utf16_length(F.coalesce("body", F.lit("")))).alias("chars"),
        F.count_if(X.is_empty_or_removed(F.col("body"))).alias("empty"), F.count_if(X.looks_non_english(F.col("body"))).alias("non_english"),
    )


def duplicate_hashes(rows: DataFrame, min_chars: int = 120) -> DataFrame:
    """Bodies that occur more than once: crossposts over several communities, reposts within one."""
    hashed = rows.select("subreddit", X.once(X.hash_if_eligible(F.col("body"), min_chars)).alias("hash")).where("hash is not null")
    return hashed.groupBy("hash").agg(_count().alias("n"), F.countDistinct("subreddit").alias("subs")).where("n > 1").withColumn(
        "kind", F.when(F.col("subs") > 1, "crosspost").otherwise("repost"),
    )


def duplicate_summary(rows: DataFrame) -> DataFrame:
    return duplicate_hashes(rows).groupBy("kind").agg(_count().alias("hashes"), F.sum("n").alias("rows"))


def top_duplicates(rows: DataFrame, n: int = 20) -> DataFrame:
    return duplicate_hashes(rows).orderBy(F.desc("n"), "hash").limit(n)


def quote_fields(items: DataFrame) -> DataFrame:
    """(id, subreddit, field, pos, quote): every verbatim quote of the analysis."""
    of = lambda field, array: F.transform(array, lambda x: F.struct(F.lit(field).alias("field"), x["quote"].alias("quote")))
    all_of = F.concat(
        F.array(F.struct(F.lit("notable_quote").alias("field"), F.col("quote").alias("quote"))), of("deal_breakers", "deal_breakers"),
        of("trust_signals", "trust_signals"), of("feature_requests", "features"),
    )
    return items.select(
        "id", "subreddit", F.posexplode(all_of).alias("pos", "q"),
    ).where("q.quote <> ''").select("id", "subreddit", "pos", "q.field", "q.quote")


def _needles(items: DataFrame) -> DataFrame:
    return quote_fields(items).withColumn("needle", X.once(X.normalize(F.col("quote")))).where(F.length("needle") >= X.QUOTE_MIN_CHARS)


def quote_provenance(items: DataFrame, bodies: DataFrame, comments: DataFrame) -> DataFrame:
    """(id, subreddit, field, pos, bucket): where each quote of 25 characters or more stands.

    Post text comes first, then human comments, then filtered ones. A quote meets only those comments of its own thread
    that hold its anchor; threads without a quote are left out before their texts are normalised.
    """
    quotes = cut(_needles(items))
    asked = quotes.select("id").distinct()
    posts = bodies.select(F.col("row_key").alias("id"), "body").join(asked, "id", "left_semi").select("id", X.normalize(F.col("body")).alias("post"))
    there = filter_comments(comments).withColumn("id", F.col("link_id")).join(asked, "id", "left_semi")
    said = there.select("id", X.once(X.normalize(F.col("body"))).alias("said"), F.col("reason").isNull().alias("by_human"))
    in_post = quotes.join(posts, "id", "left").withColumn("in_post", F.coalesce(F.instr("post", F.col("needle")) > 0, F.lit(False))).drop("post")
    in_talk = quotes.select("id", "pos", "needle").join(contained(quotes, said, "by_human"), ["id", "needle"]).drop("needle")
    bucket = F.when(F.col("in_post"), "post-body").when(F.col("by_human"), "human-comment").when(
        F.col("by_human").isNotNull(), "bot-comment",
    ).otherwise("not-found")
    return in_post.join(in_talk, ["id", "pos"], "left").select("id", "subreddit", "field", "pos", bucket.alias("bucket"))


def missing_bodies(items: DataFrame, raw: DataFrame) -> DataFrame:
    """(subreddit, read, missing): posts whose raw record is in the archive, and those where it is not. raw: (subreddit, row_key)."""
    there = raw.select("subreddit", F.col("row_key").alias("id"), F.lit(True).alias("_there")).dropDuplicates(["subreddit", "id"])
    rows = items.where("kind = 'post'").select("subreddit", "id").join(there, ["subreddit", "id"], "left")
    return rows.groupBy("subreddit").agg(F.count("_there").alias("read"), F.count_if(F.col("_there").isNull()).alias("missing"))


def quote_buckets(provenance: DataFrame) -> DataFrame:
    return provenance.groupBy("field", "bucket").agg(_count().alias("n"))


def quote_sample(provenance: DataFrame, k: int = 5) -> DataFrame:
    """``k`` quotes of each community and bucket in the order of a hash of their place, with the number there are.

    Each task keeps ``k`` of a group: the least of the hash's first characters are found with partial aggregates, and only
    rows at or below the k-th go on to be ranked.
    """
    by = ["subreddit", "bucket"]
    rows = provenance.withColumn("h", F.sha1(F.concat_ws("|", "id", "pos").cast("binary")))
    slots = rows.groupBy(*by, F.substring("h", 1, 3).alias("slot")).agg(_count().alias("n"))  # at most 4096 a group
    upto = Window.partitionBy(*by).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    last = slots.withColumn(
        "before", F.coalesce(F.sum("n").over(upto), F.lit(0)),
    ).where(F.col("before") < k).groupBy(*by).agg(F.max("slot").alias("slot"))
    seen = slots.groupBy(*by).agg(F.sum("n").alias("seen"))
    near = rows.join(last.join(seen, by), by).where(F.substring("h", 1, 3) <= F.col("slot"))
    ranked = near.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("h", "id", "pos")))
    return ranked.where(F.col("r") <= k).select(*by, "id", "pos", "seen")


def contamination(items: DataFrame, comments: DataFrame) -> DataFrame:
    """By community: rows with comments, with a filtered comment, and with a quote inside a filtered comment."""
    judged = filter_comments(comments).select(F.col("link_id").alias("id"), F.col("reason").isNotNull().alias("flagged"), "body")
    eligible = judged.groupBy("id").agg(F.bool_or("flagged").alias("broad"))
    quotes = cut(_needles(items))
    flagged = judged.where("flagged").join(quotes.select("id").distinct(), "id", "left_semi")
    said = flagged.select("id", X.once(X.normalize(F.col("body"))).alias("said"), F.lit(True).alias("narrow"))
    narrow = contained(quotes, said, "narrow").select("id", "narrow").distinct()
    rows = items.select("id", "subreddit").join(eligible, "id").join(narrow, "id", "left")
    return rows.groupBy("subreddit").agg(
        _count().alias("eligible"), F.count_if("broad").alias("broad"), F.count_if(F.coalesce("narrow", F.lit(False))).alias("narrow"),
    )


def retag_report(tagged: DataFrame) -> DataFrame:
    """Rows by the old and the new reason. tagged: rows with both, as the classifier of bodies gives them."""
    return tagged.groupBy("old_reason", F.col("content_class_reason").alias("new_reason")).agg(_count().alias("n"))
