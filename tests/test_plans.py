"""Shapes of plans that must hold at any size."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from agorascope import registry
from agorascope.operators import sections as S
from agorascope.plans import corpus as C
from agorascope.session import forget, kept, read_texts, shared_folder

SF = "/root/testdata/sf0.001"


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["resonance_top", "quotes_top", "cohort_by_frame", "classify_with_bodies", "retag_report", "topic_spikes", "discovery_candidates", "trust_board", "audit_author_concentration"])
def test_nothing_crosses(spark, name):
    plan = executed(registry.queries()[name](spark, SF))
    if name in ("resonance_top", "quotes_top", "cohort_by_frame", "topic_spikes", "trust_board", "classify_with_bodies"):  # they use rows several times
        assert not any(step in plan for step in ("documents.parquet", "from_json", "sha1", "regexp_replace"))  # all before what is cut
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["stance_by_week", "dist_stance", "rules_by_sub"])
def test_what_is_used_once_is_not_written(spark, name):
    before = set(Path(shared_folder(spark).removeprefix("file:")).rglob("*"))
    registry.queries()[name](spark, SF).collect()
    assert set(Path(shared_folder(spark).removeprefix("file:")).rglob("*")) <= before


def test_ask_writes_nothing_and_filters_in_the_scan(spark, tmp_path):
    from agorascope.operators.rows import save_analysis
    from agorascope.plans.engine import Engine

    posts = C.posts(spark, SF)
    save_analysis(posts.drop("analysis_json").withColumn("analysis_json", F.lit(None).cast("string")), posts.where("analyzed").select("subreddit", "row_key", "analysis_json"), 4).write.parquet(f"{tmp_path}/posts")
    engine = Engine(spark, spark.read.parquet(f"{tmp_path}/posts"), C.comments(spark, SF), f"{tmp_path}/engine")
    before = set(Path(shared_folder(spark).removeprefix("file:")).rglob("*"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    found = engine.ask("?", ai_only=True, stance="wary", topic="other")
    scan = next(line for line in executed(found).split("\n") if "FileScan" in line)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert all(f in scan.split("PushedFilters")[1].split("ReadSchema")[0] for f in ("stance", "ai_related"))
    assert set(Path(shared_folder(spark).removeprefix("file:")).rglob("*")) <= before
    expected = C.items(spark, SF).where("ai_related and stance = 'wary' and array_contains(topics, 'other')")
    assert {r.id for r in found.collect()} == {r.id for r in expected.collect()}


def test_sections_read_only_their_columns(spark):
    scans = [line for line in executed(registry.queries()["dist_stance"](spark, SF)).split("\n") if "FileScan parquet" in line]
    assert scans and all("n_chars" not in s and "lang" not in s.split("ReadSchema")[1] for s in scans)


def test_what_is_kept_is_forgotten(spark):
    table = kept(spark.range(10))
    assert table.count() == 10
    forget(table)
    with pytest.raises(Exception, match="(?i)not.*(exist|found)"):
        spark.read.parquet(table.inputFiles()[0].rsplit("/", 1)[0])
    forget(spark.read.parquet(f"{SF}/region.parquet"))  # not in the folder: it stays
    assert spark.read.parquet(f"{SF}/region.parquet").count() == 5


def test_what_is_parsed_is_read_once(spark):
    """The plan that the items are cut from scans the documents once and parses each analysis once."""
    posts = C.posts(spark, SF).where("analyzed")
    from agorascope.operators.rows import parse_rows

    plan = executed(parse_rows(posts).where("valid").drop("valid"))
    assert plan.count("FileScan parquet") == 3 and plan.count("from_json(") == 1  # documents, events and labels


def test_frequent_claims_are_not_shuffled(spark, monkeypatch):
    """A claim that all rows make meets its count in a broadcast; the sums are the same without."""
    items = C.items(spark, SF)
    with_broadcast = {r.id: r.salience for r in S.salience(items).collect()}
    monkeypatch.setattr(S, "FREQUENT", 0)
    assert {r.id: r.salience for r in S.salience(items).collect()} == with_broadcast
    some = items.where("ai_related")
    assert {r.id: r.salience for r in S.salience(items, some).collect()} == {r.id: with_broadcast[r.id] for r in S.human(some).select("id").collect()}


def test_small_tables_are_dealt_and_large_ones_are_not(spark, monkeypatch):
    assert read_texts(spark, SF, "documents").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("agorascope.session.SMALL", 10)
    assert "Exchange" not in executed(read_texts(spark, SF, "documents").select(F.length("text")))


def test_filters_and_columns_reach_the_scan(spark):
    scan = executed(C.posts(spark, SF).where("subreddit = 'src3'").select("row_key", "created_utc"))
    assert "EqualTo(source,src3)" in scan and "n_chars" not in scan


def _joined_columns(df):
    """Names of what goes through each join of a plan."""
    found, left = [], [df._jdf.queryExecution().optimizedPlan()]
    while left:
        node = left.pop()
        if node.nodeName() == "Join":
            found.append({a.name() for a in map(node.output().apply, range(node.output().size()))})
        left += map(node.children().apply, range(node.children().size()))
    return found


def test_texts_go_through_joins_only_for_bodies(spark):
    for name in ("ingest_dedupe", "comment_policy_dry_run", "retag_report"):
        joined = _joined_columns(registry.QUERIES[name](spark, SF))
        assert joined and not any(c & {"text", "body"} for c in joined if "conv_id" not in c), name
    assert any("text" in c for c in _joined_columns(C.posts(spark, SF).select("row_key", "body")))


def test_bodies_are_not_shuffled_again_for_their_own_key(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = C.posts(spark, SF).select(F.col("row_key").alias("id"), "body")
        asked = C.posts(spark, SF).select(F.col("row_key").alias("id")).distinct()
        plan = rows.join(asked, "id", "left_semi")._jdf.queryExecution().executedPlan().toString()
        alone = rows._jdf.queryExecution().executedPlan().toString()
        shuffles = lambda p: sum("Exchange hashpartitioning" in line for line in p.splitlines())
        assert shuffles(plan) <= 2 * shuffles(alone)  # those of each side, none for the join
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
