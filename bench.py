"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import contextlib
import io
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "cohort_by_frame", "stance_by_week", "heatmap_topic_week", "quotes_top", "resonance_top", "audit_body_stats", "audit_duplicates",
    "audit_quote_provenance", "contamination_by_sub", "classify_with_bodies", "normalize_hash", "registry_hashes", "retag_report",
)


#: Copies of the sf0.1 submissions that make a table as large as the one whose table-only retag pass was timed: 219,190 rows.
COPIES = 22


def retag_table(spark, sf):
    """Submissions without bodies, each ``COPIES`` times with a title of its own."""
    from pyspark.sql import functions as F

    from agorascope.plans import corpus
    from agorascope.session import kept

    posts = corpus.posts(spark, sf).select(
        "subreddit", "row_key", "title", "author", "distinguished", "stickied", "created_utc", "content_class", "content_class_reason",
    )
    many = posts.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(COPIES))))
    return kept(many.withColumn("row_key", F.concat_ws("-", "row_key", "i")).withColumn("title", F.concat_ws(" ", "title", "i")).drop("i"))


def main() -> None:
    from agorascope import registry
    from agorascope.plans import jobs
    from agorascope.session import session

    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = registry.queries(), {}
    queries["stance_by_week"](spark, sf).write.format("noop").mode("overwrite").save()  # compiles and warms up
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    table = retag_table(spark, sf)
    start = time.time()
    jobs.retag(table, body=None)[1].write.format("noop").mode("overwrite").save()
    took["retag_table_pass"] = round(time.time() - start, 3)
    n = table.count()
    spark.stop()
    print(json.dumps({
        "metric": "headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/")),
        "retag_rows": n, "retag_rows_per_second": round(n / took["retag_table_pass"]),
    }))


if __name__ == "__main__":
    with contextlib.redirect_stderr(io.StringIO()):
        main()
