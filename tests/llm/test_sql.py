"""The registered SQL against the DataFrames on random link graphs and odd texts."""

import random
from collections import Counter

import duckdb
import pandas as pd

from agorascope.llm import decontaminate, rules, rules_sql, urls


def rows_of(relation):
    found = relation.fetchall()
    names = [d[0] for d in relation.description]
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[names.index(n)] for n in sorted(names))) for r in found)


def rows_in(frame):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[n] for n in sorted(frame.columns))) for r in frame.collect())


def test_link_graph_sql(spark, tmp_path):
    rng = random.Random(8)
    hosts = [f"h{i}.{end}" for i in range(25) for end in ("com", "example.org", "net")]
    def page(i):
        kinds = ('<a href="http://{}/x">', "<img src='//{}'>", "<base href= https://{}/>", "see http://{}. ", '<link rel=canonical href=" //{}?q">')
        links = "".join(rng.choice(kinds).format(rng.choice(hosts)) for _ in range(rng.randint(0, 5)))
        return i, f"http://{rng.choice(hosts)}/{rng.choice(('de', 'fr', 'es', 'en/1', 'en/2'))}/{i}", links

    pd.DataFrame([page(i) for i in range(300)] + [(300, None, None), (301, "x", "")], columns=["page_id", "url", "html"]).to_parquet(tmp_path / "pages.parquet")
    found = urls.judge(spark.read.parquet(str(tmp_path / "pages.parquet")))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    expected = db.execute(urls.sql()).df().sort_values("page_id").reset_index(drop=True)
    own = pd.DataFrame([r.asDict() for r in found.collect()])[list(expected.columns)].sort_values("page_id").reset_index(drop=True)
    scores = ["trust", "distrust"]
    pd.testing.assert_frame_equal(own.drop(columns=scores).fillna("-"), expected.drop(columns=scores).fillna("-"), check_dtype=False)
    pd.testing.assert_frame_equal(own[scores], expected[scores], rtol=1e-3)  # the last digit told
    unruled = [r for r in found.collect() if r.rule is None and r.host]
    assert {r.verdict for r in unruled} == {"allow", "block"}  # the graph decides both ways


def test_text_sql(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)] + ["Ünï", "###", "|", "\n", "\t", "\n\n", " "]
    bench = [(i, " ".join(rng.choice(words[:30]) for _ in range(rng.randint(5, 25)))) for i in range(10)] + [(3, None), (4, "")]
    def text():
        own = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            own[:0] = bench[rng.randrange(10)][1].split()
        return " ".join(own)

    docs = [(i, rng.choice((None, "", "  ")) if i % 10 == 0 else text()) for i in range(80)]
    pd.DataFrame(docs, columns=["doc_id", "text"]).to_parquet(tmp_path / "documents.parquet")
    pd.DataFrame(bench, columns=["item_id", "text"]).to_parquet(tmp_path / "benchmark.parquet")
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    given = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = rules.judged(given).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "fail_bits")
    assert rows_in(found) == rows_of(db.execute(rules_sql.sql(rules.RULES, rules.BASE.rules)))
    pairs = decontaminate.overlaps(given, spark.read.parquet(str(tmp_path / "benchmark.parquet")))
    assert rows_in(pairs) == rows_of(db.execute(decontaminate.sql())) and pairs.count() > 0
