"""Bot and boilerplate detection. Rows are tagged, never deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.config import Boilerplate
from agorascope.functions import text as X
from agorascope.session import kept
from agorascope.vocabulary import BOT_AUTHORS


def reason_by_row(author: Column, distinguished: Column, stickied: Column) -> Column:
    """Reason that a row gives by itself, most certain first; null if there is none."""
    return F.when(F.lower(author).isin(*BOT_AUTHORS), "automod-author").when(
        F.lower(distinguished) == "moderator", "distinguished",
    ).when(stickied, "stickied")


def class_of(reason: Column) -> Column:
    return F.when(reason.isin("automod-author", "distinguished"), "bot").when(reason != "", "boilerplate").otherwise("human")


def repeat_counts(rows: DataFrame, hash: str, sub: str = "subreddit") -> DataFrame:
    """(sub, hash, repeats): copies within a community, counted with partial sums."""
    return rows.where(F.col(hash).isNotNull()).groupBy(F.lower(sub).alias("sub"), F.col(hash).alias("hash")).agg(F.count(F.lit(1)).alias("repeats"))


def flagged(rows: DataFrame, repeated: DataFrame, hash: str, flag: str) -> DataFrame:
    """Rows with ``flag`` true where (community, hash) is among ``repeated``.

    Rows without a hash can't match: their own key stands for it, which spreads them over all tasks instead of
    gathering a community's in one. The repeated side is broadcast where its measured size allows; else rows that
    share a hash are split by the skew join.
    """
    known = repeated.select(F.col("sub").alias("_sub"), F.col("hash").alias("_copied"), F.lit(True).alias(flag))
    keys = [F.col(k) for k in ("row_key", "id") if k in rows.columns]
    own = F.coalesce(F.col(hash), *[F.concat(F.lit("-"), k) for k in keys])
    return rows.withColumn("_own", own).join(
        known, (F.lower("subreddit") == F.col("_sub")) & (F.col("_own") == F.col("_copied")), "left",
    ).drop("_sub", "_copied", "_own")


def hashed(rows: DataFrame, limits: Boilerplate = Boilerplate(), body: str | None = None) -> DataFrame:
    """Rows with ``title_hash`` and, if ``body`` names a column, ``body_hash``; those that are stored already are kept."""
    out = rows if "title_hash" in rows.columns else rows.withColumn("title_hash", X.once(X.hash_if_eligible(F.col("title"), limits.title_chars)))
    return out.withColumn("body_hash", X.hash_if_eligible(F.col(body), limits.body_chars)) if body and "body_hash" not in rows.columns else out


def _tagged(rows: DataFrame, limits: Boilerplate, tests: dict[str, str]) -> DataFrame:
    out = rows
    for hash, flag in tests.items():
        out = flagged(out, repeat_counts(rows, hash).where(F.col("repeats") > limits.min_repeats), hash, flag)
    repeated = F.coalesce(*[F.col(flag) for flag in tests.values()], F.lit(False))
    reason = F.coalesce(reason_by_row(F.col("author"), F.col("distinguished"), F.col("stickied")), F.when(repeated, "repeat-hash"), F.lit(""))
    out = out.withColumn("content_class_reason", reason).drop(*tests, *tests.values())
    return out.withColumn("content_class", class_of(F.col("content_class_reason")))


def classify_rows(rows: DataFrame, limits: Boilerplate = Boilerplate()) -> DataFrame:
    """Rows with ``content_class`` and ``content_class_reason``, copies told by their titles.

    Copies are counted once, and only the hashes above the limit are joined back: an aggregate and a
    small join instead of a window that would gather each group's rows in one task.
    """
    return _tagged(hashed(rows, limits), limits, {"title_hash": "_t"})


def classify_bodies(rows: DataFrame, limits: Boilerplate = Boilerplate(), body: str = "body") -> DataFrame:
    """(subreddit, row_key, content_class, content_class_reason, and ``old_reason``: the tag so far), by titles and bodies.

    The texts are read and hashed once: what is left of a row, its key, flags and hashes, is kept in the shared folder,
    and the counts and joins work on that.
    """
    old = F.coalesce("content_class_reason", F.lit("")) if "content_class_reason" in rows.columns else F.lit("")
    time = ["created_utc"] if "created_utc" in rows.columns else []
    slim = hashed(rows, limits, body).select(
        "subreddit", "row_key", *time, "author", "distinguished", "stickied", "title_hash", "body_hash", old.alias("old_reason"),
    )
    return _tagged(kept(slim), limits, {"title_hash": "_t", "body_hash": "_b"}).drop("author", "distinguished", "stickied")


def classify_untagged(rows: DataFrame, limits: Boilerplate = Boilerplate()) -> DataFrame:
    """A stored tag wins; the others are classified, copies counted among them only, by title. ``title_hash`` is used if it is there."""
    fresh = F.col("content_class").isNull()
    ready = hashed(rows, limits).withColumn("title_hash", F.when(fresh, F.col("title_hash")))
    out = _tagged(ready.withColumnsRenamed({"content_class": "_stored", "content_class_reason": "_stored_reason"}), limits, {"title_hash": "_t"})
    stored = F.col("_stored").isNotNull()
    pick = {
        "content_class": F.coalesce("_stored", "content_class"),
        "content_class_reason": F.when(stored, F.col("_stored_reason")).otherwise(F.col("content_class_reason")),
    }
    return out.select(*[pick.get(c, F.col(c)).alias(c) for c in rows.columns if c != "title_hash"])


def filter_comments(comments: DataFrame, registry: DataFrame | None = None, min_chars: int = 120) -> DataFrame:
    """Comments with ``reason``, null for those that are kept. registry: (sub, hash)."""
    out, listed = comments, F.lit(None).cast("boolean")
    if registry is not None:
        out = comments.withColumn("_hash", X.hash_if_eligible(F.col("body"), min_chars))
        out, listed = flagged(out, registry.select("sub", "hash").distinct(), "_hash", "_listed"), F.col("_listed")
    return out.withColumn(
        "reason", F.coalesce(reason_by_row(F.col("author"), F.col("distinguished"), F.col("stickied")), F.when(listed, "registry-hash")),
    ).drop("_hash", "_listed")


def comment_gate(comments: DataFrame, parents: DataFrame, policy: str = "filtered", min_chars: int = 400) -> DataFrame:
    """Comments with ``selected`` and ``reason``. parents: (row_key, ai_related)."""
    known = parents.select(F.col("row_key").alias("link_id"), F.col("ai_related").alias("parent_ai"))
    out = comments.join(known, "link_id", "left")
    if policy in ("ingest-only", "all"):
        reason = F.lit("ingest-only" if policy == "ingest-only" else "policy-all")
    else:
        long = F.col("body_chars") >= min_chars
        reason = F.when(
            F.coalesce("parent_ai", F.lit(False)), "parent-ai-related",
        ).when(long & F.col("ai_prefilter_hit"), "long-and-ai-mentioning").when(~long, "too-short").otherwise("no-ai-mention")
    return out.withColumn("reason", reason).drop("parent_ai").withColumn(
        "selected", F.col("reason").isin("parent-ai-related", "long-and-ai-mentioning", "policy-all"),
    )


def harvest(rows: DataFrame, text: str, kind: str, min_chars: int, min_repeats: int = 5) -> DataFrame:
    """(sub, hash, repeats, kind): texts that repeat within a community more than ``min_repeats`` times."""
    return repeat_counts(
        rows.withColumn("_h", X.once(X.hash_if_eligible(F.col(text), min_chars))), "_h",
    ).where(F.col("repeats") > min_repeats).withColumn("kind", F.lit(kind))


def merge_registry(old: DataFrame, new: DataFrame, most: int = 4000) -> DataFrame:
    """One entry a community and hash, the one with more repeats; the ``most`` repeated of each community, by hash among equals.

    The limit is found on counts by repeats and the hash's first characters, so the entries that meet in one task to be
    ranked are at most ``most`` and those of the last of these slots.
    """
    both = old.unionByName(new).groupBy("sub", "hash").agg(F.max(F.struct("repeats", "kind")).alias("b"))
    both = both.select("sub", "hash", "b.repeats", "b.kind", F.substring("hash", 1, 3).alias("_slot"))
    slots = both.groupBy("sub", "repeats", "_slot").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("sub").orderBy(F.desc("repeats"), "_slot").rowsBetween(Window.unboundedPreceding, -1)
    open_ = slots.withColumn("before", F.coalesce(F.sum("n").over(above), F.lit(0))).where(F.col("before") < most).select("sub", "repeats", "_slot")
    rank = F.row_number().over(Window.partitionBy("sub").orderBy(F.desc("repeats"), "hash"))
    return both.join(open_, ["sub", "repeats", "_slot"]).withColumn("_r", rank).where(F.col("_r") <= most).select("sub", "hash", "repeats", "kind")


def registry_of(titles: DataFrame, limits: Boilerplate = Boilerplate()) -> DataFrame:
    """What a rollup publishes: titles that repeat within a community."""
    return harvest(titles, "title", "title", limits.title_chars, limits.min_repeats)


def admit_under_cap(pending: DataFrame, cap: int, used: int = 0, order: tuple[str, ...] = ("created_utc", "row_key")) -> DataFrame:
    """The oldest pending rows that the day's cap still allows; the others wait."""
    return pending.orderBy(*order).limit(max(0, cap - used))


def registry_summary(registry: DataFrame) -> DataFrame:
    """(sub, kind, hashes, most): what the registry holds of each community."""
    return registry.groupBy("sub", "kind").agg(F.count(F.lit(1)).alias("hashes"), F.max("repeats").alias("most"))


def filter_tally(filtered: DataFrame, day: Column) -> DataFrame:
    """(day, reason, n) of filtered comments, from the rows themselves, so that a repeated run counts nothing twice."""
    return filtered.where("reason is not null").groupBy(day.alias("day"), "reason").agg(F.count(F.lit(1)).alias("n"))


def filtered_last_day(tally: DataFrame, today: Column) -> DataFrame:
    """(reason, n) of today and yesterday."""
    return tally.where(F.col("day").between(F.date_sub(today, 1), today)).groupBy("reason").agg(F.sum("n").alias("n"))
