"""The rollup's sections over classified items, as flat tables.

Ranking is by recurrence over distinct threads, then oldest first, then id; capture-time scores are
never read. ``seen`` is a row's place in (community, id, position) order, by which examples are chosen
and ties broken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope import vocabulary as V
from agorascope.session import cut


def _key(text: Column) -> Column:
    return F.lower(F.trim(F.coalesce(text, F.lit(""))))


def _exploded(items: DataFrame, array: str, *keep: str) -> DataFrame:
    """One row an element: ``x``, its ``seen`` place, and the kept columns."""
    return items.select(
        "subreddit", "id", *[k for k in keep if k not in ("subreddit", "id")], F.posexplode(array).alias("pos", "x"),
    ).withColumn("seen", F.struct("subreddit", "id", "pos"))


def _top(frame: DataFrame, n: int, *order) -> DataFrame:
    return frame.orderBy(*order).limit(n)


def _count() -> Column:
    return F.count(F.lit(1))


def share(part: Column, whole: Column) -> Column:
    """A quotient rounded to six places, 0 over nothing."""
    return F.round(F.when(whole == 0, 0.0).otherwise(part / whole), 6)


def human(items: DataFrame) -> DataFrame:
    return items.where(F.coalesce("content_class", F.lit("human")) == "human")


def non_human(items: DataFrame) -> DataFrame:
    return items.where(F.coalesce("content_class", F.lit("human")) != "human")


def human_ai(items: DataFrame) -> DataFrame:
    return human(items).where("ai_related")


def weeks(items: DataFrame) -> DataFrame:
    """Observed weeks of all human rows; each with its rank from the newest."""
    found = human(items).where("week <> ''").select("week").distinct()
    return found.withColumn("back", F.row_number().over(Window.orderBy(F.desc("week"))) - 1)


def meta(items: DataFrame) -> DataFrame:
    is_human = F.coalesce("content_class", F.lit("human")) == "human"
    n = lambda c: F.count_if(c)
    return items.agg(
        n(is_human).alias("total_posts"), _count().alias("total_rows"), n(is_human & F.col("ai_related")).alias("ai_related"),
        n(~is_human).alias("non_human"), n(F.col("content_class") == "bot").alias("bot"),
        n(F.col("content_class") == "boilerplate").alias("boilerplate"), n(is_human & (F.col("kind") == "post")).alias("submissions"),
        n(is_human & (F.col("kind") == "comment")).alias("comments"), F.countDistinct(F.when(is_human, F.col("subreddit"))).alias("subreddits"),
        F.countDistinct(F.when(is_human & (F.col("week") != ""), F.col("week"))).alias("weeks"),
    )


def meta_lists(items: DataFrame) -> DataFrame:
    """The communities and the weeks of human rows, sorted; distinct values are found before they are gathered in one row."""
    own = human(items)
    gathered = lambda c, rows: rows.agg(F.array_sort(F.collect_list(c)).alias(c))
    subs = gathered("subreddit", own.select("subreddit").distinct())
    return subs.select(
        F.col("subreddit").alias("subreddits"), gathered("week", own.where("week <> ''").select("week").distinct()).scalar().alias("weeks"),
    )


def non_human_reasons(items: DataFrame) -> DataFrame:
    return non_human(items).groupBy(
        "content_class", F.when(F.col("content_class_reason") == "", "unknown").otherwise(F.col("content_class_reason")).alias("reason"),
    ).agg(_count().alias("n"))


def topics_table(items: DataFrame) -> DataFrame:
    return items.sparkSession.createDataFrame(list(V.TOPICS), "topic string, label string")


def heatmap_weeks(items: DataFrame) -> DataFrame:
    """Topic and week counts; topics outside the vocabulary are dropped, those without rows have one with a null week and 0."""
    counted = human_ai(items).select(
        "week", F.explode("topics").alias("topic"),
    ).where(F.col("topic").isin([t for t, _ in V.TOPICS])).groupBy("topic", "week").agg(_count().alias("n"))
    return topics_table(items).select("topic").join(counted, "topic", "left").select("topic", "week", F.coalesce("n", F.lit(0)).alias("n"))


def heatmap_subs(items: DataFrame) -> DataFrame:
    return human_ai(items).select("subreddit", F.explode("topics").alias("topic")).groupBy("subreddit", "topic").agg(_count().alias("n"))


def stance_by_week(items: DataFrame) -> DataFrame:
    return human_ai(items).groupBy("week", "stance").agg(_count().alias("n"))


def distribution(items: DataFrame, by: str) -> DataFrame:
    """Counts of a plain column (stance, experience)."""
    return human_ai(items).groupBy(by).agg(_count().alias("n"))


def source_stance(items: DataFrame) -> DataFrame:
    return human_ai(items).groupBy("source", "stance").agg(_count().alias("n"))


def topic_totals(items: DataFrame) -> DataFrame:
    return human_ai(items).select(F.explode("topics").alias("topic")).groupBy("topic").agg(_count().alias("n"))


def _tail(frame: DataFrame, name: str, n: int = 400) -> DataFrame:
    """Top ``n`` keys, with the number of distinct keys beside each."""
    counted = frame.groupBy(name).agg(_count().alias("n"), F.min("seen").alias("seen"))
    total = counted.agg(_count()).scalar().alias("distinct_total")
    return _top(counted, n, F.desc("n"), "seen").select(name, "n", total)


def tool_totals(items: DataFrame, n: int = 400) -> DataFrame:
    return _tail(_exploded(human_ai(items), "tools").withColumn("tool", F.trim("x.tool")), "tool", n)


def pain_totals(items: DataFrame, n: int = 400) -> DataFrame:
    return _tail(_exploded(human_ai(items), "pain_points").withColumn("pain", _key(F.col("x"))), "pain", n)


def baseline_totals(items: DataFrame, n: int = 400) -> DataFrame:
    return _tail(_exploded(human(items), "expected_baseline").withColumn("baseline", _key(F.col("x"))), "baseline", n)


def _examples(rows: DataFrame, by: list[str], quote: Column, k: int = 3) -> DataFrame:
    """First ``k`` quotes of each group in ``seen`` order, joined by `` | ``; partial aggregation keeps ``k`` a task."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("seen"))
    first = rows.withColumn("_q", quote).withColumn("_r", rank).where(F.col("_r") <= k)
    return first.groupBy(*by).agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("_r", "_q"))), lambda s: F.coalesce(s["_q"], F.lit(""))), " | ",
    ).alias("examples"))


def dealbreakers(items: DataFrame, n: int = 30) -> DataFrame:
    """Deal-breakers by item, the first-seen wording and kind, three examples."""
    rows = _exploded(human(items), "deal_breakers").withColumn("key", _key(F.col("x.item")))
    board = _top(
        rows.groupBy("key").agg(
            _count().alias("n"), F.min("seen").alias("seen"), F.min_by("x.item", "seen").alias("item"), F.min_by("x.kind", "seen").alias("kind"),
        ),
        n, F.desc("n"), "seen",
    )
    return board.join(
        _examples(rows.join(F.broadcast(board.select("key")), "key"), ["key"], F.col("x.quote")), "key",
    ).select("item", "kind", "n", "examples")


def dealbreaker_kinds(items: DataFrame) -> DataFrame:
    return human(items).select(F.explode("deal_breakers").alias("x")).groupBy(F.col("x.kind").alias("kind")).agg(_count().alias("n")).where("kind is not null")


def trust_board(items: DataFrame, n: int = 20) -> DataFrame:
    rows = _exploded(human(items), "trust_signals").where(F.col("x.direction").isin("builds", "breaks")).select(
        "seen", F.col("x.direction").alias("direction"), _key(F.col("x.signal")).alias("signal"), F.col("x.quote").alias("quote"),
    )
    counted = rows.groupBy("direction", "signal").agg(_count().alias("n"), F.min("seen").alias("seen"))
    board = counted.withColumn("rank", F.row_number().over(Window.partitionBy("direction").orderBy(F.desc("n"), "seen"))).where(F.col("rank") <= n)
    kept = rows.join(F.broadcast(board.select("direction", "signal")), ["direction", "signal"])
    return board.join(
        _examples(kept, ["direction", "signal"], F.col("quote")), ["direction", "signal"],
    ).select("direction", "rank", "signal", "n", "examples")


def feature_board(items: DataFrame, n: int = 25) -> DataFrame:
    """The board without a clusterer: exact names in lower case."""
    rows = _exploded(human(items), "features").withColumn("feature", F.lower(F.coalesce("x.feature", F.lit(""))))
    return _top(rows.groupBy("feature").agg(_count().alias("n"), F.min("seen").alias("seen")), n, F.desc("n"), "seen").select("feature", "n")


def feature_names(items: DataFrame, most: int = 400) -> DataFrame:
    """(member, feature, ai_related, quote, permalink, subreddit): the first features, which a clusterer is given in this order."""
    first = _top(_exploded(human(items), "features", "permalink"), most, "seen")
    at = (F.row_number().over(Window.orderBy("seen")) - 1).alias("member")  # at most ``most`` rows
    return first.select(
        at, F.col("x.feature").alias("feature"), F.coalesce("x.ai_related", F.lit(False)).alias("ai_related"), F.col("x.quote").alias("quote"),
        "permalink", "subreddit",
    )


def clustered_features(items: DataFrame, groups: DataFrame, n: int = 40, most: int = 400) -> DataFrame:
    """The board of a clusterer's groups (canonical, members: positions among the first ``most`` names).

    ``n`` is the length of a group's list. A feature is AI-related if at least half of the members that resolve are,
    and one does; the first three of them in list order are its examples. Groups without members stay.
    """
    numbered = groups.select("canonical", F.size("members").cast("long").alias("n"), F.posexplode_outer("members").alias("at", "member"))
    found = numbered.join(F.broadcast(feature_names(items, most)), "member", "left")
    votes, resolved = F.count_if("ai_related"), F.count("feature")
    listed = F.array_sort(F.collect_list(F.when(F.col("feature").isNotNull(), F.struct("at", F.coalesce("quote", F.lit("")).alias("quote")))))
    board = found.groupBy("canonical", "n").agg(
        ((votes * 2 >= resolved) & (resolved > 0)).alias("ai_related"),
        F.array_join(F.transform(F.slice(listed, 1, 3), lambda e: e["quote"]), " | ").alias("examples"),
    )
    return _top(board, n, F.desc("n"), "canonical")


def competitors(items: DataFrame, n: int = 25) -> DataFrame:
    rows = _exploded(human(items), "tools").select(
        "seen", F.trim("x.tool").alias("tool"), F.col("x.switching").alias("switching"),
        F.when(F.col("x.sentiment").isin(*V.TOOL_SENTIMENTS), F.col("x.sentiment")).otherwise("neutral").alias("sentiment"),
    ).where("tool <> ''")
    board = rows.groupBy("tool").agg(
        _count().alias("mentions"), *[F.count_if(F.col("sentiment") == s).alias(s) for s in V.TOOL_SENTIMENTS],
        F.count_if("switching").alias("switching"), F.min("seen").alias("seen"),
    )
    return _top(board, n, F.desc("mentions"), "seen").drop("seen")


def switching_moments(items: DataFrame, n: int = 40) -> DataFrame:
    rows = _exploded(human(items), "tools", "permalink", "week").where("x.switching and trim(x.tool) <> ''")
    return _top(rows, n, "seen").select(F.trim("x.tool").alias("tool"), F.col("x.context").alias("context"), "permalink", "subreddit", "week")


def claims() -> Column:
    topic = F.transform("topics", lambda t: F.struct(F.lit("topic").alias("claim"), t.alias("name")))
    return F.concat(topic, F.transform("pain_points", lambda p: F.struct(F.lit("pain").alias("claim"), _key(p).alias("name"))))


def _claimed(items: DataFrame) -> DataFrame:
    return human(items).select("thread_id", F.explode(claims()).alias("c")).where("c.name <> ''")


def recurrence(items: DataFrame) -> DataFrame:
    """(claim, name, threads): distinct threads of each topic and pain of human rows."""
    return _claimed(items).groupBy("c.claim", "c.name").agg(F.countDistinct("thread_id").alias("threads"))


#: Claims that are looked up by a broadcast, the most frequent ones; the others have at most one in this many of all rows each.
FREQUENT = 1000


def salience(items: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """(id, salience): the recurrence of a human row's claims, repeats in the row included; 0 without claims.

    ``rows`` are the rows asked for, by default all; claims recur over all ``items``. A claim that very many rows make is
    not shuffled: the ``FREQUENT`` most frequent ones are broadcast, which bounds that table.
    """
    by_thread = _claimed(items).groupBy("c.claim", "c.name", "thread_id").agg(_count().alias("n"))
    known = cut(by_thread.groupBy("claim", "name").agg(_count().alias("threads"), F.sum("n").alias("n")))
    frequent = known.orderBy(F.desc("n"), "claim", "name").limit(FREQUENT).select("claim", "name", F.col("threads").alias("often"))
    asked = human(items if rows is None else rows).select("id", F.explode_outer(claims()).alias("c")).select("id", "c.claim", "c.name")
    first = asked.join(F.broadcast(frequent), ["claim", "name"], "left")
    # rows that are answered so far have no key left and go past the second join
    rest = first.where("often is null and name is not null").join(known.select("claim", "name", "threads"), ["claim", "name"])
    told = first.select("id", F.coalesce("often", F.lit(0)).alias("threads")).unionByName(rest.select("id", "threads"))
    return told.groupBy("id").agg(F.sum("threads").alias("salience"))


def ranked(items: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` of ``items`` with their salience, which is computed for them only."""
    return rows.join(salience(items, rows), "id")


def quotes(items: DataFrame, n: int = 400) -> DataFrame:
    rows = ranked(items, human_ai(items).where("quote <> ''"))
    return _top(rows, n, F.desc("salience"), F.coalesce("created_utc", F.lit(0)), "id").select(
        "id", "quote", "stance", "experience", F.array_join("topics", ",").alias("topics"), "subreddit", "permalink", "title", "week", "kind",
        "salience",
    )


def persona_sample(items: DataFrame, n: int = 200) -> DataFrame:
    """What a persona writer is given, by the same order."""
    return _top(
        ranked(items, human_ai(items)), n, F.desc("salience"), F.coalesce("created_utc", F.lit(0)), "id",
    ).select("id", "stance", "experience", "summary", "quote")


def resonance(items: DataFrame, n: int = 50, least: int = 4) -> DataFrame:
    """Rows that ask for what the product's pillars offer, by fit and then salience, with what they hit; ``total_matching``
    beside each. The capture-time score is shown and ranks nothing."""
    pool = F.array_join(
        F.concat(
            F.transform("features", lambda f: F.coalesce(f["feature"], F.lit(""))),
            F.transform("trust_signals", lambda t: F.coalesce(t["signal"], F.lit(""))), "pain_points", F.array("quote"),
        ),
        " | ",
    )
    tests = [(F.array_contains("topics", t), p, label) for t, p, label in V.RESONANCE_TOPICS] + [(F.col("pool").rlike(f"(?i){p}"), 2, k) for k, p in V.PILLARS.items()]
    hits = F.filter(
        F.array(*[F.when(c, F.struct(F.lit(p).alias("points"), F.lit(label).alias("label"))) for c, p, label in tests]), lambda h: h.isNotNull(),
    )
    scored = human(items).withColumn("pool", pool).withColumn("hits", hits).withColumn(
        "fit", F.aggregate("hits", F.lit(0).cast("long"), lambda a, h: a + h["points"]),
    )
    rows = scored.where(F.col("fit") >= least).drop("pool")
    total = rows.agg(_count()).scalar().alias("total_matching")
    best = _top(ranked(items, rows), n, F.desc("fit"), F.desc("salience"), "subreddit", "id")
    return best.select(
        "id", "fit", F.array_join(F.transform("hits", lambda h: h["label"]), ",").alias("hits"), "title", "quote", "permalink", "subreddit", "kind",
        "salience", "score_at_capture", "stance", "experience", "week", total,
    )


def spikes(items: DataFrame) -> DataFrame:
    """Topics of the newest week against the mean of the four observed weeks before, missing weeks as 0; the highest ratio first."""
    topics = F.array(*[F.struct(F.lit(t).alias("topic"), F.lit(label).alias("label")) for t, label in V.TOPICS])
    grid = weeks(items).where("back <= 4").select("week", "back", F.inline(topics))
    full = grid.join(heatmap_weeks(items), ["topic", "week"], "left").groupBy("topic", "label").agg(
        F.coalesce(F.sum(F.when(F.col("back") == 0, F.col("n"))), F.lit(0)).alias("this_week"),
        (F.coalesce(F.sum(F.when(F.col("back") > 0, F.col("n"))), F.lit(0)) / 4).alias("mean"), F.max("back").alias("last"),
    )
    floor = F.greatest(F.col("mean"), F.lit(1.0))
    found = full.where((F.col("last") == 4) & (F.col("this_week") >= 5) & (F.col("this_week") >= 2 * floor)).select(
        "topic", "label", "this_week", F.round("mean", 1).alias("trailing_mean"), F.round(F.col("this_week") / floor, 1).alias("ratio"),
    )
    return found.orderBy(F.desc("ratio"), "topic")


def discovery(items: DataFrame, comment_mentions: DataFrame, tracked: list[str], n: int = 40, least: int = 3) -> DataFrame:
    """Communities named at least ``least`` times and neither tracked, ingested nor noise. comment_mentions: (subreddit, sub_mentions)."""
    named = lambda rows: rows.select("subreddit", F.explode("sub_mentions").alias("sub"))
    rows = named(human(items)).unionByName(named(comment_mentions)).where(F.col("sub") != "").where(~F.col("sub").isin(*tracked, *V.DISCOVERY_NOISE))
    # counted by pairs first, so that neither a popular community's mentions nor those who cite it are gathered
    own = human(items).select(F.col("subreddit").alias("sub")).distinct()
    pairs = rows.groupBy("sub", "subreddit").agg(_count().alias("n")).join(own, "sub", "left_anti")
    best = _top(pairs.groupBy("sub").agg(F.sum("n").alias("mentions")).where(F.col("mentions") >= least), n, F.desc("mentions"), "sub")
    rank = F.row_number().over(Window.partitionBy("sub").orderBy("subreddit"))
    first = pairs.join(F.broadcast(best.select("sub")), "sub").withColumn("r", rank).where("r <= 6")
    cited = first.groupBy("sub").agg(F.array_join(F.array_sort(F.collect_list("subreddit")), ",").alias("cited_by"))
    return best.join(cited, "sub").orderBy(F.desc("mentions"), "sub").select("sub", "mentions", "cited_by")


def rules(items: DataFrame) -> DataFrame:
    """Non-human rows by community and reason."""
    return non_human(items).groupBy(
        "subreddit", F.when(F.col("content_class_reason") == "", "unknown").otherwise(F.col("content_class_reason")).alias("reason"),
    ).agg(_count().alias("n"))


def rule_samples(items: DataFrame, k: int = 5) -> DataFrame:
    """Up to ``k`` different sample texts of a community's non-human rows, quote before summary before title."""
    text = F.substring(F.trim(F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("quote", "summary", "title")])), 1, 400)
    rows = non_human(items).withColumn("text", text).where("text <> ''").groupBy("subreddit", "text").agg(F.min("id").alias("first_id"))
    return rows.withColumn(
        "r", F.row_number().over(Window.partitionBy("subreddit").orderBy("first_id", "text")),
    ).where(F.col("r") <= k).select("subreddit", "first_id", "text")


def frame_of(tags: dict[str, str], kinds: dict[str, str]) -> Column:
    """Sampling frame: communities by tag, streams by kind; frames are never pooled."""
    look = lambda m, key: F.element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), key) if m else F.lit(None).cast("string")
    kind = look({k: v for k, v in kinds.items() if v in ("topic", "community")}, F.col("subreddit"))
    stream = F.coalesce(F.concat(F.lit("bluesky-"), kind), F.lit("bluesky-untagged"))
    tag = look({k.lower(): v for k, v in tags.items()}, F.lower("subreddit"))
    return F.when(F.col("source") == "bluesky", stream).otherwise(F.coalesce(F.concat(F.lit("reddit-"), tag), F.lit("reddit")))


def modal_stance(rows: DataFrame, by: tuple[str, ...] = ("frame",)) -> DataFrame:
    """(frame, author, stance): each author's most frequent stance, the first seen of equals."""
    counted = rows.where("author <> '' and author <> '[deleted]'").groupBy(*by, "author", "stance").agg(
        _count().alias("n"), F.min(F.struct("subreddit", "id")).alias("seen"),
    )
    best = counted.groupBy(*by, "author").agg(F.max("n").alias("most"))
    return counted.join(best, [*by, "author"]).where("n = most").groupBy(*by, "author").agg(F.min_by("stance", "seen").alias("stance"))


def cohort(items: DataFrame, tags: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    """Negativity of each frame by posts, authors and threads. ``is_primary`` marks the population's frame, or, if no row
    is of it, the frame that comes first in (community, id) order. Frames are as many as there are tags and kinds."""
    rows = human_ai(items).withColumn("frame", frame_of(tags, kinds))
    negative = F.col("stance").isin(*V.NEGATIVE)
    posts = rows.groupBy("frame").agg(
        _count().alias("ai_posts"), F.count_if(negative).alias("neg_posts"), F.countDistinct("thread_id").alias("distinct_threads"),
        F.countDistinct(F.when(negative, F.col("thread_id"))).alias("neg_threads"), F.count_if(negative & (F.col("intensity") >= 3)).alias("intense"),
        F.count_if(F.col("comment_mix").isNotNull()).alias("commented_posts"), F.min(F.struct("subreddit", "id")).alias("seen"),
    )
    authors = modal_stance(rows).groupBy("frame").agg(_count().alias("distinct_authors"), F.count_if(negative).alias("neg_authors"))
    both = posts.join(authors, "frame", "left").na.fill(0, ["distinct_authors", "neg_authors"])
    c = F.col
    both = both.withColumn("first", F.row_number().over(Window.orderBy((c("frame") == "reddit").desc(), "seen")) == 1)
    return both.select(
        "frame", c("first").alias("is_primary"), "ai_posts", "neg_posts", share(c("neg_posts"), c("ai_posts")).alias("neg_post_share"),
        "distinct_authors", share(c("neg_authors"), c("distinct_authors")).alias("neg_author_share"), "distinct_threads",
        share(c("neg_threads"), c("distinct_threads")).alias("neg_thread_share"), share(c("intense"), c("neg_posts")).alias("hi_intensity_neg_share"),
        "commented_posts",
    )


def cohort_basis(items: DataFrame, tags: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    rows = human_ai(items).withColumn("frame", frame_of(tags, kinds)).where(F.col("stance").isin(*V.NEGATIVE, "conflicted"))
    return rows.select("frame", "stance", F.explode("stance_basis").alias("basis")).groupBy("frame", "stance", "basis").agg(_count().alias("n"))


def comment_mix(items: DataFrame, tags: dict[str, str], kinds: dict[str, str]) -> DataFrame:
    rows = human_ai(items).withColumn("frame", frame_of(tags, kinds))
    return rows.select(
        "frame", F.explode("comment_mix").alias("stance", "c"),
    ).groupBy("frame", "stance").agg(F.sum(F.coalesce("c", F.lit(0))).alias("n"))


#: Section name to the tables it is made of; each takes the items.
SECTIONS: dict[str, dict[str, Callable[[DataFrame], DataFrame]]] = {
    "meta": {"counts": meta, "lists": meta_lists, "non_human": non_human_reasons},
    "heatmap": {"weeks": heatmap_weeks, "subs": heatmap_subs},
    "stance": {"by_week": stance_by_week},
    "distributions": {
        "experience": lambda i: distribution(i, "experience"), "stance": lambda i: distribution(i, "stance"), "source_stance": source_stance,
        "topics": topic_totals, "tools": tool_totals, "pains": pain_totals,
    },
    "features": {"board": feature_board},
    "minbar": {"baseline": baseline_totals, "dealbreakers": dealbreakers, "kinds": dealbreaker_kinds},
    "trust": {"board": trust_board},
    "quotes": {"quotes": quotes},
    "personas": {"sample": persona_sample},
    "competitors": {"board": competitors, "switching": switching_moments},
    "resonance": {"posts": resonance},
    "signals": {"spikes": spikes},
    "rules": {"reasons": rules, "samples": rule_samples},
}
