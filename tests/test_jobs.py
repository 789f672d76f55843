"""Retag, audit and model jobs with injected models."""

from pyspark.sql import functions as F

from agorascope.functions import text as X
from agorascope.operators.rows import page_after
from agorascope.plans import jobs
from agorascope.plans.engine import Engine
from tests.test_library import POST, RULE_TEXT, analysis, items, post

TALK = "kind string, row_key string, link_id string, subreddit string, body string, author string, stickied boolean, distinguished string, created_utc long, body_chars long, ai_prefilter_hit boolean, parent_id string"


def test_retag_changes_only_what_differs(spark):
    rows = [post(i, body=RULE_TEXT) for i in range(8)] + [post(9, author="AutoModerator", content_class="bot", content_class_reason="automod-author"), post(10)]
    changed, report = jobs.retag(spark.createDataFrame(rows, POST))
    assert changed.count() == 8 and {(r.old_reason, r.new_reason): r.n for r in report.collect()} == {("", "repeat-hash"): 8, ("automod-author", "automod-author"): 1, ("", ""): 1}
    without, _ = jobs.retag(spark.createDataFrame(rows, POST), body=None)
    assert without.count() == 0


def test_audit_tables(spark, tmp_path):
    rows = [post(i, analysis(i), body=f"body {i}") for i in range(6)]
    said = spark.createDataFrame([("comment", "c_1", "id0", "writing", "text", "u", False, None, 1, 4, False, None)], TALK)
    tables = jobs.audit(items(spark, rows), spark.createDataFrame(rows, POST), said, {})
    assert len(tables) == 14
    jobs.write_report({"stance": tables["stance_coherence"]}, str(tmp_path), "2026-01-01")
    assert spark.read.parquet(f"{tmp_path}/stance/2026-01-01").first().total == 6


def test_analysis_respects_gate_cap_and_filter(spark):
    pending = spark.createDataFrame([post(i, kind="post", body="see r/Drafts") for i in range(4)] + [post(8, kind="comment", row_key="c_1"), post(9, kind="comment", row_key="c_2")], POST)
    said = spark.createDataFrame([("comment", "c_1", "id0", "writing", "kept words", "u", False, None, 1, 10, False, None), ("comment", "c_2", "id1", "writing", "x", "AutoModerator", False, None, 1, 1, False, None)], TALK)
    parents = spark.createDataFrame([("id0", True)], "row_key string, ai_related boolean")

    def analyzer():
        return lambda r: {"row_key": r["row_key"], "n": len(r["comments"]), "subs": ",".join(r["sub_mentions"])}

    def run(**more):
        found = jobs.analyze(pending, said, parents, analyzer, "row_key string, n long, subs string", **more).collect()
        return {r.row_key: (r.n, r.subs) for r in found}

    assert run(cap=99) == {"id0": (1, "drafts"), "id1": (0, "drafts"), "id2": (0, "drafts"), "id3": (0, "drafts")}
    assert set(run(cap=99, policy="filtered")) == {"id0", "id1", "id2", "id3", "c_1"}
    assert set(run(cap=3, used=1)) == {"id0", "id1"} and run(cap=0) == {}


def test_a_failing_model_leaves_the_last_good_result(spark, tmp_path):
    frame = items(spark, [post(i, analysis(i)) for i in range(4)])

    def fails(*_):
        raise RuntimeError("no model")

    assert jobs.personas(spark, frame, str(tmp_path), fails) == {"_stale": True, "_staleReason": "no model"}
    good = jobs.personas(spark, frame, str(tmp_path), lambda sample, counts: {"n": len(sample), "stances": counts["stance"]})
    assert good["n"] == 4
    assert jobs.personas(spark, frame, str(tmp_path), fails) == good | {"_stale": True, "_staleReason": "no model"}
    assert jobs.brief(spark, frame, str(tmp_path), lambda pack: {"quotes": len(pack["quotes"])}) == {"quotes": 4}


def test_sections_with_settings(spark):
    frame = items(spark, [post(i, analysis(i)) for i in range(4)])
    talk = spark.createDataFrame([("a", ["b"])], "subreddit string, sub_mentions array<string>")
    tables = jobs.settings_sections(lambda: {"writing": "enclave-pro"}, {}, [], talk)
    assert tables["cohort"]["frames"](frame).select(F.first("frame")).first()[0] == "reddit-enclave-pro" and tables["discovery"]["candidates"](frame).count() == 0


def test_views_of_health_and_snapshots(spark, tmp_path):
    said = spark.createDataFrame([], TALK)
    engine = Engine(spark, spark.createDataFrame([post(i, analysis(i)) for i in range(4)], POST), said, str(tmp_path))
    for day in ("2026-01-01", "2026-01-02", "2026-01-02"):
        engine.take_snapshot(day)
    found = engine.insights("snapshots")
    assert found.select("day").distinct().count() == 2 and {r.total_rows for r in found.collect()} == {4}
    assert engine.insights("health").first().posts == 4


def test_fields_shrink_from_the_longest_down(spark):
    fields = F.expr("map('a', repeat('x', 50), 'b', repeat('y', 8), 'c', 'zz', 'd', cast(null as string))")
    kept = {n: spark.range(1).select(X.shrink_fields(fields, n).alias("s")).first().s for n in (100, 10, 9, 0)}
    assert {n: (sorted(s.kept), s.dropped) for n, s in kept.items()} == {100: (["a", "b", "c", "d"], []), 10: (["b", "c", "d"], ["a"]), 9: (["c", "d"], ["a", "b"]), 0: (["d"], ["a", "b", "c"])}


def test_what_is_dropped_is_told_and_lists_are_halved(spark):
    row = spark.range(1).select(X.marked(F.expr("map('a', 'x')"), F.expr("array('b', 'c')")).alias("m"), X.marked(F.expr("map('a', 'x')"), F.expr("cast(array() as array<string>)")).alias("n")).first()
    assert row.m == {"a": "x", "_truncated": "b,c"} and row.n == {"a": "x"}
    halved = {n: spark.range(1).select(X.shrink_list(F.expr("transform(sequence(1, 10), i -> 'xxxx')"), n).alias("l")).first().l for n in (1000, 40, 20, 1)}
    assert {n: len(v) for n, v in halved.items()} == {1000: 10, 40: 5, 20: 2, 1: 0}


def test_vectors_survive_base64(spark):
    import base64
    import struct

    values = [0.0, -0.0, 1.0, -1.5, 3.14159, 1e-40, -1e38, 2.0**-126]
    text = base64.b64encode(struct.pack("<8f", *values)).decode()
    rows = spark.createDataFrame([(text,), ("",), (None,), ("AAA",), ("AAAAAAA=",)], "t string").select(X.vector_from_base64(F.col("t")).alias("v")).collect()
    assert rows[0].v == list(struct.unpack("<8f", struct.pack("<8f", *values))) and rows[1].v == [] and [r.v for r in rows[2:]] == [None] * 3
    again = spark.createDataFrame([(values,), (None,)], "v array<float>").select(X.vector_to_base64(F.col("v")).alias("t")).collect()
    assert [r.t for r in again] == [text, None]


def test_pending_rows_are_analyzed_and_saved(spark, tmp_path):
    posts = spark.createDataFrame([post(i, analyzed=False, kind="post") for i in range(3)] + [post(9, analysis(9))], POST)

    def analyzer():
        return lambda r: {"subreddit": r["subreddit"], "row_key": r["row_key"], "analysis_json": '{"stance_on_ai": "wary", "ai_related": true}'}

    engine = Engine(spark, posts, spark.createDataFrame([], TALK), str(tmp_path))
    saved = engine.analyze_pending(analyzer, cap=2, schema_version=5)
    assert {(r.row_key, r.analyzed, r.stance) for r in saved.collect()} == {("id0", True, "wary"), ("id1", True, "wary"), ("id2", False, None), ("id9", True, None)}


def test_scan_goes_on_after_a_cursor(spark):
    rows = spark.createDataFrame([("a", 2), ("b", 1), ("a", 1), ("b", 2)], "sub string, k long")
    pages, at = [], None
    while found := [tuple(r) for r in page_after(rows, ["sub", "k"], at, 3).collect()]:
        pages.append(found)
        at = found[-1]
    assert pages == [[("a", 1), ("a", 2), ("b", 1)], [("b", 2)]]
