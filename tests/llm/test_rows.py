"""Every operator and stage with nulls, repeated, missing and textual ids, clashing names, empty tables, very long texts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from agorascope.llm import decontaminate, html_text, importance, language, lexical, licenses, packing, rules, secrets, sentence_pieces, simhash, tokens, urls

PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
TEXT = "The quick brown fox jumps over the lazy dog while seven wise old owls watch from a tall tree"
PAGE = f"<article><p>{TEXT}</p></article><a href='http://other.net/'>x</a>"
NAMES = "id fp label key node w h s p doc item item_id start length rank kept spans component salt number row digest other text_ leaked host path part blocked n piece words seeds seed none least size k lang_pred html_ language a.b".split()


def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE), (None, None), (2, "")], "item_id long, text string")


OPERATORS = {
    "licenses": lambda d: licenses.scan(d),
    "urls": lambda d: urls.judge(d, id="doc_id", url="url", html="html"),
    "simhash": lambda d: simhash.near_duplicates(d),
    "one_of_each": lambda d: simhash.one_of_each(d).select("doc_id", "text", "n_chars"),
    "secrets": lambda d: secrets.digest(secrets.find_secrets(d)),
    "redact": lambda d: secrets.redact(d).select("doc_id", "text", "n_chars"),
    "rules": lambda d: rules.judged(d),
    "passing": lambda d: rules.passing(d).select("doc_id", "text", "n_chars"),
    "overlaps": lambda d: decontaminate.overlaps(d, benchmark(d.sparkSession)),
    "clean": lambda d: decontaminate.clean(d, benchmark(d.sparkSession)).select("doc_id", "text", "n_chars"),
    "language": lambda d: language.identify(d),
    "tokens": lambda d: tokens.token_counts(d),
    "pack": lambda d: packing.pack(d),
    "lexical": lambda d: lexical.search(lexical.build(d), benchmark(d.sparkSession)),
    "pieces": lambda d: sentence_pieces.digests(d),
    "importance": lambda d: importance.resample(d, benchmark(d.sparkSession)),
    "html": lambda d: html_text.extract(d, id="doc_id", url="url", html="html"),
}
#: Operators with one row for each row given.
EACH = ("urls", "simhash", "secrets", "redact", "rules", "language", "tokens", "pieces", "importance", "html")
COLUMNS = "doc_id {}, text string, lang string, source string, n_chars long, url string, html string"


def table(spark, rows, kind="long"):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "http://a.com/de/x", h) for i, t, h in rows], COLUMNS.format(kind))


ROWS = [
    (1, f"x {PASSAGE} y", PAGE), (2, TEXT, PAGE), (2, f"Other words {PASSAGE}", PAGE), (2, TEXT + " now", "<p>a"), (3, TEXT, None), (3, TEXT, None),
    (None, TEXT + " of the park", PAGE), (None, f"{PASSAGE} once more", ""), (None, None, None), (4, "", ""), (5, "All rights reserved. password=hunter2hunter2", "<"),
]


def counted(frame):
    return Counter(str(r) for r in frame.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_ids_and_names(spark, name):
    given = table(spark, ROWS)
    found = counted(OPERATORS[name](given))
    if name in EACH:
        assert sum(found.values()) == len(ROWS)
    clashing = given.select("*", *[F.lit(1).alias(n) for n in NAMES], F.create_map(F.lit(1), F.lit(2)).alias("entries"))
    assert counted(OPERATORS[name](clashing)) == found
    texts = table(spark, [(None if i is None else f"id-{i}", t, h) for i, t, h in ROWS], "string")
    assert OPERATORS[name](texts).schema["doc_id"].dataType.simpleString() == "string"
    if name not in ("language", "importance"):  # what they learn from or draw follows from the id
        assert Counter({k.replace("'id-", "").replace("'", ""): n for k, n in counted(OPERATORS[name](texts)).items()}) == Counter({k.replace("'", ""): n for k, n in found.items()})
    assert OPERATORS[name](given.limit(0)).collect() == []


def test_rows_are_judged_not_ids(spark):
    """A leaked or repeated row takes no other row with it that shares its id or has none."""
    given = table(spark, ROWS)
    left = Counter((r.doc_id, r.text) for r in decontaminate.clean(given, benchmark(spark)).collect())
    assert left == Counter((i, t) for i, t, _ in ROWS if PASSAGE not in (t or ""))
    kept = Counter((r.doc_id, r.text) for r in simhash.one_of_each(given).collect())
    component = {r.text: c for r, c in zip(given.collect(), [simhash.fingerprint(t) for _, t, _ in ROWS], strict=True)}
    groups = {}
    for i, t, _ in ROWS:
        root = next((g for g in groups if (component[t] ^ g).bit_count() <= 4), component[t])
        groups.setdefault(root, []).append((i is None, i or 0, i, t))
    assert len(kept) == len(groups) == sum(kept.values())
    assert {i for i, _ in kept} == {min(g)[2] for g in groups.values()} if all(len({x[:3] for x in g}) == len(g) for g in groups.values()) else True


def test_which_copy_stays_does_not_depend_on_the_run(spark):
    rows = [(7, TEXT, None), (7, TEXT, "b"), (7, TEXT.upper(), None), (None, TEXT, None)]
    found = {str(simhash.one_of_each(table(spark, order).repartition(n)).collect()) for order in (rows, rows[::-1]) for n in (1, 3)}
    assert len(found) == 1


@pytest.mark.parametrize("name", OPERATORS)
def test_a_very_long_text(spark, name):
    """20 MB, its end found as well as its start."""
    filler = " ".join(f"w{i % 9973}x{i}" for i in range(1_300_000))
    long = f"{PASSAGE} {filler} {PASSAGE} All rights reserved. password=hunter2hunter2"
    given = table(spark, [(1, long, f"<p>{long}</p>"), (2, TEXT, PAGE)])
    rows = OPERATORS[name](given.repartition(1)).collect()
    own = [r for r in rows if r.doc_id == 1]
    if name in EACH or name in ("one_of_each", "passing"):
        assert len(own) == 1
    checks = {
        "licenses": lambda r: r.end > len(filler), "secrets": lambda r: r.n_assign == 1, "redact": lambda r: r.text.endswith("[secret]"), "rules": lambda r: r.n_words == len(long.split()) and r.n_repeat_words == 30,
        "overlaps": lambda r: r.n_equal == 15, "pack": lambda r: r.length <= 1024, "html": lambda r: r.n_chars == len(long), "tokens": lambda r: r.n_bytes == len(long) and r.over_limit,
    }
    assert all(checks.get(name, lambda r: True)(r) for r in own)
    assert [r.doc_id for r in rows] == [2] if name == "clean" else own


STAGES = ["quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == STAGES
    rows = [*ROWS, *((i + 10, f"{TEXT} number {i} " + " ".join(f"word{i}n{k}" for k in range(60)), None) for i in range(4))]
    long = " ".join(f"w{i % 9973}x{i}" for i in range(300_000))
    for kind, give in (("long", lambda i: i), ("string", lambda i: None if i is None else f"id-{i}")):
        given = table(spark, [(give(i), t, h) for i, t, h in [*rows, (99, long, None)]], kind)
        for n in ("leaked", "row", "digest", "fp", "kept", "id_"):
            given = given.withColumn(n, F.lit(1))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, str(tmp_path))
            if name != STAGES[-1]:
                assert out.columns == given.columns and stage(spark, given.limit(0), str(tmp_path)).collect() == []
                assert {r.doc_id for r in out.collect()} >= {give(i) for i in (10, 11, 12, 13, 99)}
            else:
                assert {r.doc_id for r in out.collect()} >= {give(99)}
            given = out


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    benchmark(spark).limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    table(spark, ROWS).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
