"""The engine's jobs: rollup, views, ask, export, reanalyze, retag, audit, health, snapshot, analysis of pending rows."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.config import Boilerplate, ConfigError
from agorascope.functions import text as X
from agorascope.operators import classify as K
from agorascope.operators import rows as R
from agorascope.operators import sections as S
from agorascope.plans.states import CorruptState, States
from agorascope.plans.store import Versions, append_log
from agorascope.plans.tables import PartitionedTable
from agorascope.session import cut, forget, kept


def ask_rows(
    items: DataFrame, vector: list[float] | None = None, ai_only: bool = False, stance: str | None = None, topic: str | None = None,
    subreddit: str | None = None, n: int = 300, least_vectors: int = 50,
) -> DataFrame:
    """Rows for an answer: filtered, then by similarity to ``vector`` if enough rows have an ``emb``, else the newest."""
    rows = items
    if ai_only:
        rows = rows.where("ai_related")
    if stance:
        rows = rows.where(F.col("stance") == stance)
    if topic:
        rows = rows.where(F.array_contains("topics", topic))
    if subreddit:
        rows = rows.where(F.lower("subreddit") == subreddit.lower())
    if vector is not None and "emb" in rows.columns:
        have = rows.agg(F.count("emb").alias("have"), F.count(F.lit(1)).alias("rows")).first()
        if have["have"] and have["have"] >= min(least_vectors, have["rows"]):
            scored = rows.withColumn("similarity", X.dot(F.col("emb").cast("array<double>"), F.array(*[F.lit(float(x)) for x in vector])))
            return scored.orderBy(F.desc_nulls_last("similarity"), "id").limit(n)
    return rows.orderBy(F.desc("created_utc"), "id").limit(n)


def stored_filter(
    posts: DataFrame, ai_only: bool = False, stance: str | None = None, topic: str | None = None, subreddit: str | None = None, **_,
) -> DataFrame:
    """Stored rows that ``ask_rows`` may choose, by the columns that stand beside the analysis, so that the scan skips the others
    and their analyses are not parsed. Rows saved before there were such columns have null there and go on to be parsed."""
    rows, has = posts, set(posts.columns)
    def only(column: str, condition: Column) -> None:
        nonlocal rows
        if column in has:
            rows = rows.where(F.col(column).isNull() | condition)

    if ai_only:
        only("ai_related", F.col("ai_related"))
    if stance:
        only("stance", F.col("stance") == stance)
    if topic:
        only("topics_csv", F.contains(F.concat(F.lit(","), "topics_csv", F.lit(",")), F.lit(f",{topic},")))
    if subreddit and not isinstance(subreddit, Column):
        rows = rows.where(F.lower("subreddit") == subreddit.lower())
    return rows


def reanalyze_selection(
    rows: DataFrame, sub: str | None = None, kind: str | None = None, below_version: int | None = None, force: bool = False, limit: int = 1000,
) -> DataFrame:
    """Rows to analyze again: older than a schema version, or any with ``force``."""
    out = rows.where("created_utc is not null")
    if sub:
        out = out.where(F.lower("subreddit") == sub.lower())
    if kind:
        out = out.where(F.coalesce("kind", F.lit("post")) == kind)
    if below_version is not None and not force:
        out = out.where(F.coalesce("schema_version", F.lit(1)) < below_version)
    return out.orderBy("row_key").limit(limit)


def health(posts: DataFrame, comments: DataFrame) -> DataFrame:
    said = comments.agg(F.count(F.lit(1))).scalar().alias("comments")
    return posts.agg(
        F.count(F.lit(1)).alias("posts"), F.count_if("analyzed").alias("analyzed"), F.count_if(~F.col("analyzed")).alias("pending"),
    ).select("*", said)


def snapshot(items: DataFrame) -> DataFrame:
    """Headline numbers; ``total_rows`` counts all rows, the stances human AI rows."""
    total = items.agg(F.count(F.lit(1))).scalar().alias("total_rows")
    ai = items.where("ai_related").agg(F.count(F.lit(1))).scalar().alias("ai_rows")
    return S.distribution(items, "stance").select(total, ai, "stance", "n")


def comment_corpus(comments: DataFrame, parents: DataFrame, min_chars: int = 400) -> DataFrame:
    """(reason, selected, n, share): the dry run of the filtered policy over all comments, no model called."""
    counted = K.comment_gate(comments, parents, "filtered", min_chars).groupBy("reason", "selected").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("reason", "selected", "n", S.share(F.col("n"), counted.agg(F.sum("n")).scalar()).alias("share"))


def export_rows(rows: DataFrame) -> DataFrame:
    """Analyzed rows as they are given away: capture-time numbers say so in their names, an analysis that doesn't parse is null."""
    got = lambda c, kind="string": F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    analysis = F.from_json(F.concat(F.lit("["), "analysis_json", F.lit("]")), "array<variant>")
    return rows.where("analyzed").select(
        "subreddit", F.col("row_key").alias("id"), "title", "author", F.when(
            F.col("kind") == "comment", "comment",
        ).otherwise("post").alias("kind"), "link_id", "parent_id",
        F.col("score").alias("score_at_capture"), F.col("num_comments").alias("num_comments_at_capture"), "created_utc", "permalink", "flair",
        F.coalesce(
            "schema_version", F.lit(1),
        ).alias("schema_version"), F.coalesce(got("emb"), F.lit("")).alias("emb"), F.to_json(F.when(F.size(analysis) == 1, F.get(analysis, F.lit(0)))).alias("analysis"),
    )


@dataclass
class Settings:
    """What defines the corpus; each is asked for only by the sections that need it, which fail by its name."""

    tags: dict[str, str] | None = None
    kinds: dict[str, str] = field(default_factory=dict)
    tracked: tuple[str, ...] = ()
    limits: Boilerplate = Boilerplate()
    comment_min_chars: int = 400

    def sub_tags(self) -> dict[str, str]:
        if not self.tags:
            raise ConfigError("SUB_TAGS", "frames would be pooled without the communities' tags")
        return self.tags


@dataclass
class Summary:
    written: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    rows_scanned: int = 0
    rows_analyzed: int = 0
    skipped_rows: int = 0
    would_select: int = 0
    registry_hashes: int = 0
    seconds: float = 0.0

    @property
    def ok(self) -> bool:
        return not self.failed


def run_sections(items: DataFrame, store: Versions, sections: dict | None = None) -> Summary:
    """Write every section's tables, in order; a failing section is noted, its last good tables stay, and the others go on.

    A table's builder takes the items; one that takes a second argument is given ``read(section, table)`` of what
    the sections before it have written.
    """
    out = Summary()
    for name, tables in (sections or S.SECTIONS).items():
        try:
            store.write(
                name, {table: build(items, store.table) if getattr(build, "reads", False) else build(items) for table, build in tables.items()},
            )
            out.written.append(name)
        except Exception as failure:  # one bad section never ends the run
            out.failed[name] = str(failure).split("\n")[0][:500]
            store.fail(name, out.failed[name])
    return out


def reading(build: Callable) -> Callable:
    """Marks a table's builder that reads what earlier sections have written."""
    build.reads = True
    return build


#: Rollups whose health rows stay.
LAST_RUNS = 100


class Engine:
    """Jobs over a store: ``posts`` and ``comments`` tables, sections under ``path``, and injected model calls.

    ``models`` may hold ``features`` (names to groups), ``personas`` (sample and counts to a dict) and ``brief``
    (an evidence pack to a dict). Without a model its section has the evidence only.
    """

    VIEWS = (*S.SECTIONS, "cohort", "discovery", "brief", "snapshot", "comment_corpus", "registry", "health", "snapshots", "status", "all")
    #: The table that a view shows where none is named.
    FIRST = {
        "cohort": "frames", "discovery": "candidates", "brief": "made", "snapshot": "headline", "comment_corpus": "dry_run", "registry": "hashes",
    } | {k: next(iter(v)) for k, v in S.SECTIONS.items()}

    def __init__(
        self, spark: SparkSession, posts: DataFrame, comments: DataFrame, path: str, answer: Callable | None = None, notify: Callable | None = None,
        settings: Settings | None = None, models: dict[str, Callable] | None = None, table: PartitionedTable | None = None,
    ):
        self.spark, self.posts, self.comments, self.path, self.answer, self.notify = spark, posts, comments, path, answer, notify
        self.settings, self.models, self.store = settings or Settings(), models or {}, Versions(spark, path)
        #: The stored table of ``posts``, if results are to be merged into it.
        self.table = table

    def items(self) -> DataFrame:
        """Classified items, parsed where they are used; jobs that use them many times keep them meanwhile."""
        return K.classify_untagged(
            K.hashed(R.parse_rows(self.posts.where("analyzed")).where("valid").drop("valid"), self.settings.limits), self.settings.limits,
        )

    def sections(self) -> dict[str, dict[str, Callable]]:
        """All sections, those that need settings, comments, models or other sections' tables among them, in order."""
        from agorascope.plans import jobs

        s = self.settings
        parents = lambda i: i.select(F.col("id").alias("row_key"), "ai_related")
        mentions = self.comments.select("subreddit", "sub_mentions") if "sub_mentions" in self.comments.columns else None
        found = dict(S.SECTIONS) | jobs.settings_sections(s.sub_tags, s.kinds, s.tracked, mentions)
        if {"body_chars", "ai_prefilter_hit", "link_id"} <= set(self.comments.columns):
            found["comment_corpus"] = {"dry_run": lambda i: comment_corpus(self.comments, parents(i), s.comment_min_chars)}
        if "features" in self.models:
            found["features"] = {"board": lambda i: jobs.feature_section(i, self.models["features"])}
        if "personas" in self.models:
            found["personas"] = {
                "sample": S.persona_sample, "made": reading(jobs.made(self.spark, "personas", jobs.persona_evidence, self.models["personas"])),
            }
        if "brief" in self.models:
            found["brief"] = {"made": reading(jobs.made(self.spark, "brief", jobs.brief_evidence, self.models["brief"]))}
        found["snapshot"] = {"headline": snapshot}
        return found

    def rollup(self, sections: dict | None = None) -> Summary:
        """All sections from one kept copy of the items; then the registry, the spike digest and a health row, none of them fatal."""
        began = datetime.now(UTC)
        parsed = kept(K.hashed(R.parse_rows(self.posts.where("analyzed")), self.settings.limits))
        items = kept(K.classify_untagged(parsed.where("valid").drop("valid"), self.settings.limits))
        try:
            return self._rolled(parsed, items, sections, began)
        finally:
            forget(items, parsed)

    def _rolled(self, parsed: DataFrame, items: DataFrame, sections: dict | None, began: datetime) -> Summary:
        done = run_sections(items, self.store, sections or self.sections())
        counts = parsed.agg(F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("valid")).first()
        done.rows_scanned, done.rows_analyzed, done.skipped_rows = counts["n"], counts["valid"], counts["n"] - counts["valid"]
        if "comment_corpus" in done.written:
            done.would_select = self.store.table("comment_corpus", "dry_run").where("selected").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        for name, step in (("registry", lambda: self._publish(items, done)), ("notify", lambda: self._tell(done))):
            try:
                step()
            except Exception as failure:
                done.failed[name] = str(failure).split("\n")[0][:500]
        done.seconds = (datetime.now(UTC) - began).total_seconds()
        row = [(
            done.ok, done.written, [f"{k}: {v}" for k, v in done.failed.items()], done.rows_scanned, done.rows_analyzed, done.skipped_rows,
            done.would_select, done.registry_hashes, done.seconds, datetime.now(UTC),
        )]
        schema = "ok boolean, written array<string>, failed array<string>, rows_scanned long, rows_analyzed long, skipped_rows long, would_select long, registry_hashes long, seconds double, finished_at timestamp"
        append_log(self.spark, f"{self.path}/rollup_health", row, schema, lambda log: log.orderBy(F.desc("finished_at")).limit(LAST_RUNS))
        return done

    def _publish(self, items: DataFrame, done: Summary) -> None:
        """The registry with the titles that repeat among the items, merged into what it holds."""
        self.publish(K.registry_of(items, self.settings.limits))
        done.registry_hashes = self.registry().count()

    def _tell(self, done: Summary) -> None:
        if self.notify and "signals" in done.written:
            found = [r.asDict() for r in self.store.table("signals", "spikes").collect()]  # at most one a topic
            if found:
                self.notify(found)

    def registry(self) -> DataFrame:
        found = self.store.table("registry", "hashes")
        return found if found is not None else self.spark.createDataFrame([], "sub string, hash string, repeats long, kind string")

    def publish(self, entries: DataFrame) -> None:
        """Merge entries (sub, hash, repeats, kind) into the registry as its next version."""
        self.store.write("registry", {"hashes": K.merge_registry(self.registry(), entries)})

    def insights(self, view: str, table: str | None = None):
        """A section's table as last written; ``health``, ``status``, all days' ``snapshots``, or ``all``: a dict of every view's first table."""
        if view == "all":
            current = self.store.current()
            found = {v: self.store.table(v, self.FIRST[v], current) for v in self.VIEWS if v in self.FIRST}
            return {v: t for v, t in found.items() if t is not None} | {"health": self.health()}
        if view == "health":
            return self.health()
        if view == "status":
            return self.store.status()
        if view == "snapshots":
            return self.spark.read.parquet(f"{self.path}/snapshots")
        if view not in self.FIRST:
            raise ValueError(f"unknown view {view}; views are {', '.join(self.VIEWS)}")
        found = self.store.table(view, table or self.FIRST[view])
        if found is None:
            raise ValueError(f"{view} has not been written yet")
        return found

    def ask(self, question: str, vector: list[float] | None = None, **filters):
        """The answerer's reply on the chosen rows, or the rows if there is no answerer. Nothing is written.

        Rows are chosen by their stored columns first; only what is left is parsed, and judged by the analysis itself.
        Their class is the stored one, as no answer depends on it.
        """
        chosen = stored_filter(self.posts.where("analyzed"), **filters)
        vectors = ("emb",) if vector is not None and "emb" in chosen.columns else ()
        parsed = R.parse_rows(chosen, vectors).where("valid").drop("valid")
        if vectors:
            parsed = parsed.withColumn("emb", X.vector_from_base64(F.col("emb")))
        rows = ask_rows(parsed, vector, **filters)
        return self.answer(question, rows.collect()) if self.answer else rows

    def take_snapshot(self, day: str) -> None:
        """The day's headline numbers; a second run on the same day replaces them."""
        snapshot(self.items()).write.mode("overwrite").parquet(f"{self.path}/snapshots/day={day}")

    def export(self, path: str) -> None:
        export_rows(self.posts).write.mode("overwrite").json(path)

    def health(self) -> DataFrame:
        """One row: counts now, the last rollup, the comments filtered today and yesterday, and the registry's size."""
        from agorascope.plans.store import read_or_none

        counts = health(self.posts, self.comments)
        runs = read_or_none(self.spark, f"{self.path}/rollup_health")
        last = lambda c: runs.agg(F.max_by(c, "finished_at")).scalar() if runs is not None else F.lit(None)
        tally = read_or_none(self.spark, f"{self.path}/filter_tally")
        filtered = K.filtered_last_day(tally, F.current_date()).agg(F.coalesce(F.sum("n"), F.lit(0))).scalar() if tally is not None else F.lit(0)
        return counts.select(
            "*", last("finished_at").alias("last_rollup_at"), last("ok").alias("last_rollup_ok"), last("skipped_rows").alias("last_rollup_skipped"),
            last("written").alias("last_rollup_written"), last("failed").alias("last_rollup_failed"), filtered.alias("filtered_last_day"),
            self.registry().agg(F.count(F.lit(1))).scalar().alias("registry_hashes"),
        )

    def reanalyze(self, put: Callable[[DataFrame], None] | None = None, **choice) -> DataFrame:
        """The rows to analyze again, given to ``put`` (a queue or pending table) if there is one."""
        chosen = reanalyze_selection(self.posts.where("analyzed"), **choice)
        if put:
            put(chosen)
        return chosen

    def retag(self, bodies: bool = True, dry_run: bool = False, save: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """The report of a retag. The rows with their new tags go to ``save``, and what repeats to the registry, unless it is a dry run."""
        from agorascope.plans import jobs

        changed, report = jobs.retag(self.posts, self.settings.limits, "body" if bodies else None)
        if not dry_run:
            if save:
                save(R.save_tags(self.posts, changed))
            found = K.registry_of(self.posts, self.settings.limits)
            if bodies:
                found = found.unionByName(K.harvest(self.posts, "body", "body", self.settings.limits.body_chars, self.settings.limits.min_repeats))
            self.publish(found)
            self.store.write("retag", {"report": report})
            report = self.store.table("retag", "report")
            if self.table:
                self._merged(dated(changed), R.save_tags)
        return report

    def _merged(self, changes: DataFrame, put: Callable) -> None:
        """Merge into the stored table; from then on ``posts`` are its rows as they are now."""
        self.table.merge(changes, put)
        self.posts = self.table.read()

    def audit(self, raw: DataFrame | None = None) -> dict[str, DataFrame]:
        """Every table of the audit, written as the latest version and read back."""
        from agorascope.plans import jobs

        items = kept(self.items())
        try:
            tables = jobs.audit(items, self.posts, self.comments, self.settings.tags or {}, raw)
            self.store.write("audit", tables)
        finally:
            forget(items)
        current = self.store.current()
        return {name: self.store.table("audit", name, current) for name in tables}

    def audit_in_steps(self, run: str, raw: DataFrame | None = None) -> tuple[dict[str, DataFrame], str | None]:
        """As ``audit``, table by table: a run of this name that died goes on with the tables that it hasn't written.

        The second value tells why the run began anew, if the state of its progress was damaged; None if it was whole or
        there was none.
        """
        from agorascope.plans import jobs

        states, restarted = States(self.spark, f"{self.path}/_states"), None
        try:
            state = states.load("audit") or {}
        except CorruptState as damage:
            state, restarted = {}, str(damage)
        done = state.get("done", []) if state.get("run") == run else []
        items = kept(self.items())
        try:
            tables = jobs.audit(items, self.posts, self.comments, self.settings.tags or {}, raw)
            for name, table in tables.items():
                if name not in done:
                    self.store.write(f"audit_{name}", {name: table})
                    done = [*done, name]
                    states.save("audit", {"run": run, "done": done})
        finally:
            forget(items)
        current = self.store.current()
        return {name: self.store.table(f"audit_{name}", name, current) for name in tables}, restarted

    def ingest(self, frames: list, store: str, **more) -> DataFrame:
        from agorascope.streaming import ingest

        return ingest.run_ingest(self.spark, frames, store, **more)

    def backfill(self, store: str, client: str, subs: list[str], before: int, **more) -> DataFrame:
        from agorascope.streaming import ingest

        return ingest.backfill(self.spark, store, client, subs, before, **more)

    def analyze_pending(
        self, analyzer: Callable, cap: int, schema_version: int, used: int = 0, policy: str = "ingest-only",
        save: Callable[[DataFrame], None] | None = None,
    ) -> DataFrame:
        """Pending rows through the gate, the cap and the filter to the model; the stored rows with its results go to ``save``."""
        from agorascope.plans import jobs

        parents = self.posts.where("kind <> 'comment' or kind is null").select("row_key", self._ai().alias("ai_related"))
        pending = self.posts.where("not analyzed").withColumn("kind", F.coalesce("kind", F.lit("post")))
        made = cut(jobs.analyze(
            pending, self.comments, parents, analyzer, "subreddit string, row_key string, analysis_json string", cap, used, policy,
            self.settings.comment_min_chars, self.registry(),
        ))
        put = lambda old, new: R.save_analysis(old, new, schema_version)
        if self.table:
            times = pending.select("subreddit", "row_key", "created_utc").dropDuplicates(["subreddit", "row_key"])
            self._merged(dated(made.join(times, ["subreddit", "row_key"])), lambda old, new: put(old, new.drop("created_utc")))
        stored = self.posts if self.table else put(self.posts, made)
        if save:
            save(stored)
        return stored

    def _ai(self) -> Column:
        return F.coalesce(F.get_json_object("analysis_json", "$.ai_related").cast("boolean"), F.lit(False))


def dated(rows: DataFrame) -> DataFrame:
    """With the day under which the store has a row."""
    from agorascope.streaming.ingest import day_of

    return rows.withColumn("day", day_of(F.col("created_utc")))


def analyze_pending(rows: DataFrame, analyzer: Callable[[], Callable[[dict], dict]], schema: str) -> DataFrame:
    """Model output for each pending row. ``analyzer()`` makes one client a task; filter before, since Python stages stop pushdown."""
    import pandas as pd

    def run(batches):
        client = analyzer()
        for batch in batches:
            yield pd.DataFrame([client(r) for r in batch.to_dict("records")])

    return rows.mapInPandas(run, schema)


def one_row(spark: SparkSession, value: dict, stale: str | None) -> DataFrame:
    return spark.createDataFrame([(json.dumps(value), stale is not None, stale)], "value string, stale boolean, stale_reason string")
