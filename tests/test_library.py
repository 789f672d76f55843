"""The reference cases of the library, each check shown able to fail."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from agorascope import config
from agorascope.functions import text as X
from agorascope.operators import audit as A
from agorascope.operators import classify as K
from agorascope.operators import rows as R
from agorascope.operators import sections as S
from agorascope.plans import engine as E
from agorascope.plans.store import Versions

POST = "source string, kind string, subreddit string, row_key string, title string, body string, author string, permalink string, score int, num_comments int, created_utc long, distinguished string, stickied boolean, flair string, link_id string, parent_id string, sub_mentions array<string>, content_class string, content_class_reason string, analyzed boolean, schema_version int, analysis_json string"
NAMES = [c.split()[0] for c in POST.split(", ")]
RULE_TEXT = "Please read the rules of this community before you post anything here, and remember that every excerpt needs a content warning and a word count in its title."
MEGATHREAD = "Able to beta? Post here! The weekly beta reader matching thread"


def post(i, analysis=None, **more):
    base = dict(zip(NAMES, [None] * len(NAMES), strict=True)) | {"subreddit": "writing", "row_key": f"id{i}", "title": f"t{i}", "author": f"author{i % 5}", "score": i, "created_utc": 1_760_000_000 + i, "stickied": False, "analyzed": True, "sub_mentions": []}
    return tuple((base | {"analysis_json": analysis if isinstance(analysis, str) or analysis is None else json.dumps(analysis)} | more)[n] for n in NAMES)


def analysis(i=0, **more):
    return {"week": f"2026-W3{i % 6}", "ai_related": True, "stance_on_ai": ["hostile", "wary", "curious", "pragmatic"][i % 4], "topics": ["other"], "pain_points": ["P1"], "notable_quote": f"quote {i}"} | more


def items(spark, posts):
    rows = spark.createDataFrame(posts, POST)
    return K.classify_untagged(R.parse_rows(rows).where("valid").drop("valid"))


def test_strict_parsing(spark):
    cases = {"{}": True, '{"week": "a"}': True, '{"week": "a': False, "{} x": False, "{}}": False, "null": False, "7": False, None: False, "garbage": False, "[]": False, '{"tools_mentioned": null, "topics": null}': True}
    rows = spark.createDataFrame([post(i, c) for i, c in enumerate(cases)], POST)
    assert [r.valid for r in R.parse_rows(rows).orderBy(F.expr("cast(substring(id, 3) as int)")).collect()] == list(cases.values())
    row = R.parse_rows(spark.createDataFrame([post(0, "{}")], POST)).first()
    assert (row.stance, row.topics, row.ai_related, row.source, row.kind, row.thread_id) == ("na", [], False, "reddit", "post", "id0")


def test_old_tools_are_bare_strings(spark):
    row = R.parse_rows(spark.createDataFrame([post(0, {"tools_mentioned": ["Pen", {"tool": "Quill", "sentiment": "positive", "switching": True, "context": "c"}]})], POST)).first()
    assert [tuple(t) for t in row.tools] == [("Pen", "neutral", False, ""), ("Quill", "positive", True, "c")]


@pytest.mark.parametrize(("copies", "subs", "expected"), [(8, 1, 8), (3, 1, 0), (5, 1, 0), (6, 1, 6), (8, 8, 0)])
def test_repeated_bodies(spark, copies, subs, expected):
    rows = spark.createDataFrame([post(i, body=RULE_TEXT, subreddit=f"s{i % subs}") for i in range(copies)], POST)
    assert K.classify_bodies(rows).where("content_class_reason = 'repeat-hash'").count() == expected


def test_rows_without_a_hash_are_spread_and_texts_hashed_once(spark):
    rows = spark.createDataFrame([post(i, title="short", body=f"body {i}") for i in range(40)], POST)
    found = K.classify_bodies(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "sha1" not in plan and "regexp_replace" not in plan  # the hashes were made before the cut
    assert found.where("content_class = 'human'").count() == 40
    known = spark.createDataFrame([("s", "h")], "sub string, hash string")
    keys = K.flagged(rows.withColumn("title_hash", F.lit(None).cast("string")), known, "title_hash", "f")._jdf.queryExecution().analyzed().toString()
    assert "concat(-, row_key" in keys  # a row's own key stands for a missing hash


def test_repeated_titles_and_precedence(spark):
    rows = [post(i, title=MEGATHREAD) for i in range(8)] + [post(9, author="AutoModerator", distinguished="moderator", stickied=True), post(10, distinguished="Moderator", stickied=True), post(11, stickied=True)] + [post(20 + i, title="Looking for readers") for i in range(30)]
    found = {r.row_key: (r.content_class, r.content_class_reason) for r in K.classify_rows(spark.createDataFrame(rows, POST)).collect()}
    assert found["id0"] == ("boilerplate", "repeat-hash") and found["id9"] == ("bot", "automod-author") and found["id10"] == ("bot", "distinguished")
    assert found["id11"] == ("boilerplate", "stickied") and found["id25"] == ("human", "")


def test_stored_tag_wins(spark):
    found = {r.id: r.content_class for r in items(spark, [post(i, analysis(i), title=MEGATHREAD, content_class="human" if i == 0 else None) for i in range(8)]).collect()}
    assert found.pop("id0") == "human" and set(found.values()) == {"boilerplate"}


def test_bots_never_reach_sentiment(spark):
    rows = [post(i, analysis(0), author="AutoModerator") for i in range(8)] + [post(10 + i, analysis(2)) for i in range(6)]
    found = items(spark, rows)
    assert {r.stance: r.n for r in S.stance_by_week(found).collect()} == {"curious": 6}
    unfiltered = found.groupBy("stance").count().collect()
    assert {r.stance: r["count"] for r in unfiltered} == {"curious": 6, "hostile": 8}


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def ranks_by_score(frame):
    """A step that orders, filters or groups reads a score; scans and projections merely carry it."""
    return any(("score" in line or "num_comments" in line) and not any(k in line for k in ("LogicalRDD", "LocalRelation", "Project ")) for line in plan(frame).split("\n"))


def test_no_section_reads_capture_scores_and_all_filter_bots(spark):
    frame = items(spark, [post(i, analysis(i)) for i in range(3)])
    for name, tables in S.SECTIONS.items():
        for table, build in tables.items():
            assert not ranks_by_score(build(frame)), (name, table)
            assert "human" in plan(build(frame)), (name, table)
    assert ranks_by_score(frame.orderBy("score_at_capture").select("id", "score_at_capture"))  # the check can fail
    assert "human" not in plan(spark.range(3).groupBy("id").count())


def test_order_ignores_scores(spark):
    rows = [post(i, analysis(i, topics=["ai-boundaries" if i else "other"], pain_points=[]), link_id=None) for i in range(4)]
    first = [r.id for r in S.quotes(items(spark, rows)).collect()]
    changed = [post(i, analysis(i, topics=["ai-boundaries" if i else "other"], pain_points=[]), score=1000 - i) for i in range(4)]
    assert first == [r.id for r in S.quotes(items(spark, changed)).collect()] == ["id1", "id2", "id3", "id0"]


def test_a_thread_counts_once(spark):
    rows = [post(0, analysis(0)), post(1, analysis(1), link_id="id0"), post(2, analysis(2))]
    assert {(r.claim, r.name): r.threads for r in S.recurrence(items(spark, rows)).collect()} == {("topic", "other"): 2, ("pain", "p1"): 2}


def test_week_key(spark):
    def expected(t):
        jan1 = datetime(t.year, 1, 1, tzinfo=UTC)
        days = (t - jan1).total_seconds() / 86400
        return f"{t.year}-W{-(-(days + (jan1.weekday() + 1) % 7 + 1) // 7):02.0f}"

    times = [datetime(2024, 1, 6, 0, 0, 0, tzinfo=UTC), datetime(2024, 1, 6, 0, 0, 1, tzinfo=UTC), datetime(2023, 12, 31, 23, 59, 59, tzinfo=UTC), datetime(2020, 2, 29, 12, tzinfo=UTC)]
    rows = spark.createDataFrame([(int(t.timestamp()),) for t in times], "t long").select(X.week_key(F.col("t")).alias("w")).collect()
    assert [r.w for r in rows] == [expected(t) for t in times]


def test_text_functions(spark):
    row = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert row(X.normalize(F.lit("**Hello**  [label](page) &amp; 2024-01-02 `code` ```a\nb``` END"))) == "hello label code end"
    assert row(X.sub_mentions(F.lit("see r/Writing and r/writing, r/ab, éar/nope r/Other_1"), F.lit("WRITING"))) == ["other_1"]
    assert [row(X.mentions_ai(F.lit(t))) for t in ("I use AI.", "éai", "said", "ChatGPT!", "prompted", "emails")] == [True, True, False, True, True, False]
    assert [row(X.is_empty_or_removed(F.lit(t))) for t in ("[removed]", "[Deleted]", "", "   ", "short", "a text that is long enough")] == [True] * 5 + [False]
    assert row(X.utf16_length(F.lit("😀ok"))) == 4
    assert row(F.array_join(X.chunks(F.lit("abcdefg"), 3), "|")) == "abc|def|g"
    assert row(X.looks_non_english(F.lit("il est une fois dans la ville un homme qui marche et qui parle"))) and not row(X.looks_non_english(F.lit("it was the best of times and it was the worst of times")))


def test_cohort_frames_are_not_pooled(spark):
    rows = [post(i, analysis(0), subreddit="Enclave", author=f"a{i}") for i in range(6)] + [post(10 + i, analysis(2), author=f"b{i}") for i in range(3)] + [post(20, analysis(1), source="bluesky", subreddit="novel")]
    found = {r.frame: r for r in S.cohort(items(spark, rows), {"enclave": "enclave-pro"}, {}).collect()}
    assert set(found) == {"reddit-enclave-pro", "reddit", "bluesky-untagged"}
    assert found["reddit"].neg_post_share == 0 and found["reddit"].is_primary and found["reddit-enclave-pro"].neg_author_share == 1


def test_spikes(spark):
    rows = [post(100 * w + i, analysis(0, week=f"2026-W{10 + w}")) for w in range(5) for i in range(12 if w == 4 else 2)]
    found = S.spikes(items(spark, rows)).collect()
    assert [(r.topic, r.this_week, r.trailing_mean, r.ratio) for r in found] == [("other", 12, 2.0, 6.0)]
    assert S.spikes(items(spark, rows[2:])).collect() == []  # only three weeks before


def test_discovery(spark):
    rows = [post(i, analysis(i), sub_mentions=["newsub", "askreddit", "writing"]) for i in range(3)]
    talk = spark.createDataFrame([("other", ["newsub"])], "subreddit string, sub_mentions array<string>")
    assert [tuple(r) for r in S.discovery(items(spark, rows), talk, []).collect()] == [("newsub", 4, "other,writing")]


def test_author_concentration(spark):
    rows = [post(i, analysis(0), author="one") for i in range(40)] + [post(100 + i, analysis(0), author=f"u{i}") for i in range(60)]
    found = A.author_concentration(items(spark, rows)).first()
    assert (found.total_authors, found.total_ai, found.top1_share, found.top10_share) == (61, 100, 0.4, 0.46)


def test_week_spikes_and_strays(spark):
    rows = [post(100 * w + i, analysis(0, week=f"2026-W{11 + w}")) for w in range(5) for i in range(25 if w == 3 else 5)] + [post(900 + i, analysis(0, week="2018-W42")) for i in range(5)]
    found = {r.week: r for r in A.week_concentration(items(spark, rows)).collect()}
    assert found["2026-W14"].spike and found["2026-W14"].median == 5 and found["2018-W42"].stray and not found["2026-W11"].spike


def test_quote_provenance(spark):
    talk = "kind string, row_key string, link_id string, body string, author string, stickied boolean, distinguished string"
    said = spark.createDataFrame([("comment", "c_1", "id0", "I think that the HUMAN comment says this here", "u", False, None), ("comment", "c_2", "id0", "the automatic message of this place is long", "AutoModerator", False, None)], talk)
    quotes = [{"signal": "s", "direction": "builds", "quote": q} for q in ("human comment says this here", "automatic message of this place", "nobody ever said this sentence", "short")]
    rows = [post(0, analysis(0, notable_quote="post body holds these words", trust_signals=quotes), body="My post body holds these words, truly.")]
    posts = spark.createDataFrame(rows, POST)
    found = {r.pos: r.bucket for r in A.quote_provenance(items(spark, rows), posts, said).collect()}
    assert found == {0: "post-body", 1: "human-comment", 2: "bot-comment", 3: "not-found"}
    report = A.contamination(items(spark, rows), said).first()
    assert (report.eligible, report.broad, report.narrow) == (1, 1, 1)


def test_duplicates(spark):
    rows = [post(0, body=RULE_TEXT, subreddit="a"), post(1, body=RULE_TEXT, subreddit="b"), post(2, body=RULE_TEXT + " more", subreddit="a"), post(3, body=RULE_TEXT + " more", subreddit="a"), post(4, body="other")]
    found = {r.kind: (r.hashes, r["rows"]) for r in A.duplicate_summary(spark.createDataFrame(rows, POST)).collect()}
    assert found == {"crosspost": (1, 2), "repost": (1, 2)}


def test_registry(spark):
    rows = spark.createDataFrame([("Sub", RULE_TEXT)] * 8 + [("sub", RULE_TEXT + " two")] * 2, "subreddit string, body string")
    found = K.harvest(rows, "body", "comment-body", 120)
    assert [(r["sub"], r.repeats) for r in found.collect()] == [("sub", 8)]
    more = found.withColumn("repeats", F.col("repeats") + 4).withColumn("kind", F.lit("body"))
    assert [(r.repeats, r.kind) for r in K.merge_registry(found, more).collect()] == [(12, "body")]
    talk = spark.createDataFrame([("Sub", "u", "** " + RULE_TEXT.upper() + " **", None, False), ("Sub", "u", "short", None, False), ("Sub", "u", RULE_TEXT[:90], "moderator", False)], "subreddit string, author string, body string, distinguished string, stickied boolean")
    assert sorted(str(r.reason) for r in K.filter_comments(talk, found).collect()) == ["None", "distinguished", "registry-hash"]


def test_registry_limit_against_a_sort(spark):
    rows = [(f"s{i % 2}", f"{i * 7919 % 65536:04x}{i:012x}", 6 + i % 3, "title") for i in range(3000)]
    given = spark.createDataFrame(rows, "sub string, hash string, repeats int, kind string")
    found = {(r["sub"], r.hash, r.repeats) for r in K.merge_registry(given, given.limit(0), 900).collect()}
    assert found == {r[:3] for sub in ("s0", "s1") for r in sorted((r for r in rows if r[0] == sub), key=lambda r: (-r[2], r[1]))[:900]}


def test_comment_gate(spark):
    talk = spark.createDataFrame([("p1", 10, False), ("p2", 500, True), ("p2", 500, False), ("p2", 10, True)], "link_id string, body_chars long, ai_prefilter_hit boolean")
    parents = spark.createDataFrame([("p1", True), ("p2", False)], "row_key string, ai_related boolean")
    assert {r.reason: r.selected for r in K.comment_gate(talk, parents).collect()} == {"parent-ai-related": True, "long-and-ai-mentioning": True, "no-ai-mention": False, "too-short": False}
    assert K.comment_gate(talk, parents, "ingest-only").where("selected").count() == 0
    assert [K.comment_gate(talk, parents, min_chars=n).where("reason = 'long-and-ai-mentioning'").count() for n in (5, 400, 1000)] == [2, 1, 0]


def test_merge_keeps_analysis(spark):
    old = spark.createDataFrame([("a", "old", True)], "k string, title string, analyzed boolean")
    new = spark.createDataFrame([("a", "new"), ("b", "first")], "k string, title string")
    assert {tuple(r) for r in R.merge_rows(old, new, ["k"]).collect()} == {("a", "new", True, False), ("b", "first", None, True)}


def test_sections_are_isolated(spark, tmp_path):
    def broken(_):
        raise RuntimeError("boom")

    frame = items(spark, [post(i, analysis(i)) for i in range(4)])
    store = Versions(spark, str(tmp_path))
    done = E.run_sections(frame, store, {"meta": S.SECTIONS["meta"], "bad": {"t": broken}, "stance": S.SECTIONS["stance"]})
    assert done.written == ["meta", "stance"] and done.failed == {"bad": "boom"}
    assert {r.section: (r.ok, r.error) for r in store.status().collect()} == {"meta": (True, None), "bad": (False, "boom"), "stance": (True, None)}
    assert store.table("meta", "counts").first().total_posts == 4 and store.table("bad", "t") is None
    # a section that fails midway leaves its last good tables, and a good run clears its error
    half = {"meta": {"counts": lambda i: S.meta(i.limit(0)), "later": broken}}
    assert E.run_sections(frame, store, half).failed == {"meta": "boom"} and store.table("meta", "counts").first().total_posts == 4
    E.run_sections(frame.limit(1), store, {"bad": S.SECTIONS["meta"]})
    assert store.status().where("section = 'bad'").first().ok and store.table("bad", "counts").first().total_rows == 1


TALK = "kind string, row_key string, link_id string, subreddit string, body string, author string, stickied boolean, distinguished string, created_utc long, body_chars long, ai_prefilter_hit boolean, parent_id string, sub_mentions array<string>"


def full_corpus(spark):
    """Forty analyzed rows over six weeks, some with each list, two that don't parse, and comments."""
    def full(i):
        return analysis(
            i, topics=["other", "provenance-proof", "continuity-consistency"], pain_points=["P1", f"p{i % 3}"], persona={"experience": "hobbyist", "goal": "g"}, stance_basis=["craft-quality"], stance_intensity=i % 4, expected_baseline=["B1"],
            deal_breakers=[{"item": "X", "kind": "cost", "quote": f"q{i}"}], trust_signals=[{"direction": "builds", "signal": "s", "quote": "t"}], feature_requests=[{"feature": f"F{i % 4}", "ai_related": i % 2 == 0, "quote": f"want {i}"}],
            tools_mentioned=[{"tool": "Pen", "sentiment": "positive", "switching": True, "context": "c"}], summary="s", comment_stance_mix={"hostile": 1},
        )

    rows = [post(i, full(i), sub_mentions=["bookbinding"] if i % 10 == 0 else [], title=f"The weekly thread of this community, number {i % 2}") for i in range(40)] + [post(50, "{cut"), post(51, "null")]
    said = [("comment", f"c_{i}", f"id{i}", "writing", "text", "u", False, None, i, 500, i % 2 == 0, None, ["bookbinding"]) for i in range(4)]
    return spark.createDataFrame(rows, POST), spark.createDataFrame(said, TALK)


def test_whole_rollup(spark, tmp_path):
    posts, said = full_corpus(spark)
    told = []
    models = {"features": lambda names: [("all", list(range(len(names)))), ("none", [999])], "personas": lambda sample, counts: {"n": len(sample)}, "brief": lambda pack: {"boards": sorted(pack)}}
    engine = E.Engine(spark, posts, said, str(tmp_path), notify=told.append, settings=E.Settings(tags={"writing": "enclave-pro"}, tracked=("drafts",), limits=config.Boilerplate(min_repeats=50)), models=models)
    done = engine.rollup()
    assert done.failed == {} and done.ok and (done.rows_scanned, done.rows_analyzed, done.skipped_rows) == (42, 40, 2)
    expected = {"meta", "heatmap", "stance", "distributions", "features", "minbar", "trust", "cohort", "quotes", "personas", "competitors", "resonance", "signals", "discovery", "rules", "brief", "snapshot"}
    assert expected <= set(done.written) and done.would_select == 4
    assert engine.insights("meta").first().total_posts == 40 and engine.insights("cohort").first().frame == "reddit-enclave-pro"
    assert [tuple(r) for r in engine.insights("discovery").collect()] == [("bookbinding", 8, "writing")]
    board = {r.canonical: r for r in engine.insights("features").collect()}
    assert (board["all"].n, board["all"].ai_related, board["all"].examples) == (40, True, "want 0 | want 1 | want 10") and (board["none"].n, board["none"].ai_related, board["none"].examples) == (1, False, "")
    assert engine.insights("snapshot").count() == 4 and engine.insights("comment_corpus").count() == 1
    assert json.loads(engine.insights("personas", "made").first().value) == {"n": 40} and "quotes" in json.loads(engine.insights("brief").first().value)["boards"]
    health = engine.insights("health").first()
    assert health.last_rollup_ok and health.last_rollup_skipped == 2 and len(health.last_rollup_written) == len(done.written)
    assert set(engine.insights("all")) >= expected - {"snapshot"}
    with pytest.raises(ValueError):
        engine.insights("nope")

    def fails(*_):
        raise RuntimeError("no model")

    engine.models = dict.fromkeys(models, fails)
    assert engine.rollup({k: v for k, v in engine.sections().items() if k in models}).failed == {}
    row = engine.insights("personas", "made").first()
    assert json.loads(row.value) == {"n": 40} and row.stale and row.stale_reason == "no model"
    assert {r.degraded for r in engine.insights("features").collect()} == {"no model"} and engine.insights("features").count() == 4
    # missing tags fail the cohort alone, whose last good tables stay
    engine.settings = E.Settings()
    assert set(engine.rollup({k: v for k, v in engine.sections().items() if k in ("cohort", "stance")}).failed) == {"cohort"}
    assert engine.insights("cohort").count() == 1 and "SUB_TAGS" in engine.insights("status").where("section = 'cohort'").first().error


def test_rollup_publishes_repeated_titles(spark, tmp_path):
    posts, said = full_corpus(spark)
    engine = E.Engine(spark, posts, said, str(tmp_path))
    assert engine.rollup({"meta": S.SECTIONS["meta"]}).registry_hashes == 2
    assert {(r["sub"], r.repeats, r.kind) for r in engine.registry().collect()} == {("writing", 20, "title")}
    again = engine.registry().withColumn("repeats", F.lit(3).cast("long")).withColumn("kind", F.lit("comment-body"))
    engine.publish(again)  # the entry with more repeats stays
    assert {r.repeats for r in engine.registry().collect()} == {20}
    report = engine.retag(save=lambda rows: rows.write.parquet(f"{tmp_path}/tagged"))
    assert {(r.old_reason, r.new_reason): r.n for r in report.collect()} == {("", "repeat-hash"): 40, ("", ""): 2}
    assert spark.read.parquet(f"{tmp_path}/tagged").where("content_class = 'boilerplate'").count() == 40


def test_engine_without_sections_of_its_own(spark, tmp_path):
    posts = spark.createDataFrame([post(i, analysis(i)) for i in range(6)] + [post(7, "{cut")], POST)
    engine = E.Engine(spark, posts, spark.createDataFrame([], TALK), str(tmp_path), answer=lambda q, rows: f"{q} {len(rows)}")
    done = engine.rollup({k: S.SECTIONS[k] for k in ("stance", "signals")})
    assert done.skipped_rows == 1 and not done.failed and engine.insights("stance").count() > 0
    assert engine.ask("how many", stance="wary") == "how many 2"
    engine.export(f"{tmp_path}/export")
    out = {r.id: r for r in spark.read.json(f"{tmp_path}/export").collect()}
    assert len(out) == 7 and json.loads(out["id1"].analysis)["stance_on_ai"] == "wary" and out["id7"].analysis is None and out["id2"].score_at_capture == 2
    assert R.row_of(posts, "Writing", "id3").count() == 1 and R.row_of(posts, "writing", "nope").count() == 0
    chosen = []
    assert engine.reanalyze(put=lambda rows: chosen.append(rows.count()), force=True).count() == chosen[0] == 7
    tables = engine.audit(raw=posts.where("row_key <> 'id1'").select("subreddit", "row_key"))
    assert (tables["missing"].first().read, tables["missing"].first().missing) == (5, 1)


def test_saved_analysis(spark):
    long = analysis(1, summary="x" * 40_000, notable_quote="kept")
    rows = spark.createDataFrame([post(i, analyzed=False) for i in range(3)], POST)
    made = spark.createDataFrame([("writing", "id1", json.dumps(long)), ("writing", "id2", json.dumps(analysis(2)))], "subreddit string, row_key string, analysis_json string")
    saved = {r.row_key: r for r in R.save_analysis(rows, made, 4).collect()}
    assert len(saved) == 3 and saved["id0"].analyzed is False and saved["id0"].title == "t0" and saved["id0"].analysis_json is None
    one = json.loads(saved["id1"].analysis_json)
    assert saved["id1"].analyzed and saved["id1"].analysis_truncated == "summary" and one == {k: v for k, v in long.items() if k != "summary"} and saved["id1"].stance == "wary"
    assert (saved["id2"].topics_csv, saved["id2"].week, saved["id2"].schema_version, saved["id2"].analysis_truncated) == ("other", "2026-W32", 4, "") and json.loads(saved["id2"].analysis_json) == analysis(2)


def test_one_row_a_key_is_the_newest_whatever_the_run(spark):
    rows = [("a", "k", t, v) for t, v in ((1, "old"), (3, "new"), (2, "mid"))]
    for order in (rows, rows[::-1]):
        given = spark.createDataFrame(order, "subreddit string, row_key string, created_utc long, v string")
        assert [r.v for r in R.admit(given.limit(0), given, ["subreddit", "row_key"]).collect()] == ["new"]


def test_only_top_level_replies_count(spark):
    said = spark.createDataFrame([("p", f"c{i:02}", i, None if i % 2 else "c00") for i in range(50)], "link_id string, row_key string, created_utc long, parent_id string")
    found = R.first_replies(said).orderBy("position").collect()
    assert [r.created_utc for r in found] == list(range(1, 41, 2))


def test_ask_by_similarity(spark):
    rows = items(spark, [post(i, analysis(i)) for i in range(3)]).withColumn("emb", F.array(F.expr("cast(substring(id, 3) as double)"), F.lit(1.0)))
    assert [r.id for r in E.ask_rows(rows, [1.0, 0.0]).collect()] == ["id2", "id1", "id0"]


def test_settings():
    for name, call, bad in (("SUBREDDITS", config.subreddits, ("", " , ")), ("SUB_TAGS", config.sub_tags, ("", "x", "[]")), ("BSKY_STREAMS", config.streams, ("", "[]", '[{"name": "a"}]', '[{"name": "a", "q": "b", "kind": "odd"}]'))):
        for value in bad:
            with pytest.raises(config.ConfigError) as error:
                call({name: value})
            assert error.value.setting == name
    assert config.stream_kinds({"BSKY_STREAMS": "?"}) == {} and config.stream_kinds({"BSKY_STREAMS": '[{"name": "a", "q": "b", "kind": "community"}]'}) == {"a": "community"}
    assert config.comment_policy({"COMMENT_ANALYZE_POLICY": "al"}) == "ingest-only"
    assert config.daily_cap({})[0] == 0 and config.daily_cap({"DAILY_ANALYZE_CAP": "lots"})[0] == 0 and config.daily_cap({"DAILY_ANALYZE_CAP": "7"}) == (7, None)


def test_quotes_are_found_by_their_anchors(spark):
    """Every needle against every text of its thread, words cut at both ends; few texts are searched for each."""
    import random

    from agorascope.operators import quotes as Q

    rng = random.Random(4)
    words = [f"word{i}" for i in range(60)] + ["of", "the", "a"]
    texts = [("t", " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), i % 3 == 0) for i in range(300)] + [("other", "of the a word1", True), ("t", None, True), ("t", "", True)]
    needles = [("t", "not a single text has these words"), ("t", "word1"), ("other", "of the a word1"), ("none", "of the a"), ("t", "of the")]
    for _ in range(400):
        said = rng.choice(texts)[1] or "of the"
        at = rng.randrange(len(said) or 1)
        needles.append(("t", said[at : at + rng.randint(3, 60)].strip() or "of"))
    found = Q.contained(spark.createDataFrame(needles * 2, "id string, needle string"), spark.createDataFrame(texts * 2, "id string, said string, human boolean"), "human")
    expected = {}
    for i, needle in needles:
        flags = [h for j, said, h in texts if i == j and said and needle in said]
        if flags:
            expected[i, needle] = any(flags)
    assert {(r["id"], r.needle): r.human for r in found.collect()} == expected


def test_a_megathread_of_quotes_grows_in_proportion(spark):
    """Twice the quotes and twice the comments of one thread: twice the texts searched, not four times."""
    from agorascope.operators import quotes as Q

    def searched(n):
        texts = spark.range(n).select(F.lit("mega").alias("id"), F.concat(F.lit("this is of the comment number n"), "id", F.lit(" of them and of the thread")).alias("said"), F.lit(True).alias("human"))
        needles = spark.range(n).select(F.lit("mega").alias("id"), F.concat(F.lit("is of the comment number n"), "id", F.lit(" of them and")).alias("needle"))
        found = Q.contained(needles, texts, "human")
        assert found.count() == n
        return Q.candidates(needles, texts, "human").count()

    assert (searched(200), searched(400)) == (200, 400)
