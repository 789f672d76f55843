"""URL filters: prefix rules, and link-graph propagation for hosts without one. DataFrame functions only.

Trust flows along host links from hosts with allowed pages (personalised PageRank); distrust flows
against them from hosts with blocked pages. Both flow until they settle. A host is blocked if its
distrust is more than ``RATIO`` times its trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.llm.common import cut, named

#: Fixed values: (host, path, verdict). A rule holds for the host and its subdomains.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DAMPING, RATIO = 0.85, 2.0
#: Largest relative change of a settled score, and the rounds between two looks at it and two cuts.
TOLERANCE, ROUNDS = 1e-6, 8
#: Significant digits that are told of a score.
DIGITS = 4
#: Hosts with more than one in this many of all pages are hot, so there are fewer of them than this; their pages are dealt in parts.
HOT, PARTS = 256, 64
#: Rounds after which scores that still move are an error.
MOST_ROUNDS = 4096
#: Addresses that name a host, in any attribute or in the text: href, src, base, canonical and the like, with or without a scheme.
LINK = r"""(?i)(?:["'=]\s*|https?:)//([^"'\s<>/?#\\]+)"""
#: What may follow an address in a text and is no part of its host.
AFTER = "[.,;:!)\\]]+$"
#: Rounds of the registered SQL, which has no loop: what is left is a 1e-8 of all.
SQL_ROUNDS = 112
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://``: host with A-Z lowered, and path. Both empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Rules are written into the plan, so keep them to hundreds."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts, counted. Only addresses that name a host lead to another one.

    Pages without a host or html have none; repeated pages each count; an empty table gives an empty table.
    """
    found = pages.select(host_and_path(named(url))[0].alias("src"), F.explode_outer(F.regexp_extract_all(named(html), F.lit(LINK), F.lit(1))).alias("link"))
    dst = F.regexp_replace(F.translate("link", UPPER, LOWER), AFTER, "")
    return found.select("src", dst.alias("dst")).where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, hot: int = HOT, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(host, trust, distrust) from seeds (host, allowed, blocked: page counts) and links (src, dst, n).

    Scores are never rounded and move until no score changes by more than ``tolerance`` of itself, so
    neither a host's distance from the seeds nor the size of the table decides. What moved in a round is
    kept beside the score, and a link of each host to itself carries the score over, so a round is one join
    and one sum, combined before the shuffle. What reaches a host without links ends there. Hosts that nothing
    reaches are not returned; without seeds there are none. A score under 1e-308 is lost.

    The links of a hub, a host with more than one in ``hot`` of all links of a kind, are dealt in ``PARTS`` to as many copies
    of its score. Rounds are as many as the longest chain of hosts from a seed has links, and some; more than
    ``most_rounds`` are an error, not a result.
    """
    total = seeds.agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")).first()
    of = lambda column, kind: seeds.where(F.col(column) > 0).select("host", F.lit(kind).alias("kind"), (F.lit(1 - damping) * F.col(column) / F.lit(total[column])).alias("score"))
    score = cut(of("allowed", "t").unionByName(of("blocked", "d")).withColumn("moved", F.col("score")))
    ways = links.select(F.col("src").alias("host"), F.lit("t").alias("kind"), F.col("dst").alias("to"), "n")
    ways = ways.unionByName(links.select(F.col("dst").alias("host"), F.lit("d").alias("kind"), F.col("src").alias("to"), "n"))
    out = ways.groupBy("host", "kind").agg(F.sum("n").alias("all"))
    ways = cut(ways.join(out, ["host", "kind"]).select("host", "kind", "to", (damping * F.col("n") / F.col("all")).alias("w")))
    if not ways.isEmpty():
        hosts = score.select("host", "kind").union(ways.select("to", "kind")).distinct()
        ways = ways.unionByName(hosts.select("host", "kind", F.col("host").alias("to"), F.lit(None).cast("double").alias("w")))
        sizes = cut(ways.groupBy("host", "kind").agg(F.count(F.lit(1)).alias("links")))
        hubs = F.broadcast(cut(sizes.where(F.col("links") * hot > sizes.agg(F.sum("links")).first()[0]).select("host", "kind", F.lit(True).alias("hub"))))
        part = F.when(F.col("hub"), F.pmod(F.xxhash64("to"), F.lit(PARTS)).cast("int")).otherwise(0)
        ways = cut(ways.join(hubs, ["host", "kind"], "left").select("host", "kind", part.alias("part"), "to", "w"))
        copies = F.when(F.col("hub"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
        change, rounds = None, 0
        while change is None or change > tolerance:
            rounds += ROUNDS
            if rounds > most_rounds:
                raise RuntimeError(f"scores still move by {change:.1e} of themselves after {most_rounds} rounds")
            for _ in range(ROUNDS):
                flow = F.col("moved") * F.col("w")
                dealt = score.join(hubs, ["host", "kind"], "left").select("host", "kind", "score", "moved", F.explode(copies).alias("part"))
                went = dealt.join(ways, ["host", "kind", "part"]).select(F.col("to").alias("host"), "kind", F.coalesce(flow, "score").alias("score"), F.coalesce(flow, F.lit(0.0)).alias("moved"))
                score = went.groupBy("host", "kind").agg(F.sum("score").alias("score"), F.sum("moved").alias("moved"))
            score = cut(score.where("score > 0"))
            change = score.agg(F.max(F.col("moved") / F.col("score"))).first()[0] or 0.0
    pick = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    return score.groupBy("host").agg(pick("t").alias("trust"), pick("d").alias("distrust"))


def judge(pages: DataFrame, rules=RULES, ratio: float = RATIO, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) for every page, the scores to ``DIGITS`` significant digits.

    A null url, or one without ``://``, has an empty host and path, no rule, and is allowed: nothing
    speaks against it. Hosts that no seed reaches have no trust or distrust and are allowed too.
    Repeated rows each come back, null ids and null html stay, ids may be of any type, other columns are
    not read, an empty table gives an empty table. Pages of a hot host are dealt in parts to their scores.
    """
    host, path = host_and_path(named(url))
    ruled = pages.select(named(id).alias("id"), named(url).alias("url"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = ruled.select("*", name.alias("rule"), verdict.alias("by_rule"))
    count = lambda v: F.sum(F.when(F.col("by_rule") == v, 1).otherwise(0))
    hosts = cut(ruled.groupBy("host").agg(F.count(F.lit(1)).alias("n"), count("allow").alias("allowed"), count("block").alias("blocked")))
    scores = propagate(hosts.where("allowed + blocked > 0"), host_links(pages, url, html))
    slack = 1 + TOLERANCE
    blocked = F.coalesce(F.col("distrust") > ratio * slack * F.col("trust"), F.lit(False))
    tell = lambda c: F.format_string(f"%.{DIGITS - 1}e", F.col(c)).cast("double").alias(c)
    told = scores.select("host", blocked.alias("blocked"), tell("trust"), tell("distrust"))
    most = hosts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(hosts.where(F.col("n") * HOT > most).select("host", F.lit(True).alias("hot")))
    parts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "url"), F.lit(PARTS)).cast("int")).otherwise(0)
    told = told.join(hot, "host", "left").select("host", "blocked", "trust", "distrust", F.explode(parts).alias("part"))
    rows = ruled.join(hot, "host", "left").withColumn("part", part)
    method = F.when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    return rows.join(told, ["host", "part"], "left").select(F.col("id").alias(id), "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "trust", "distrust")


def sql(rules=RULES) -> str:
    """The registered query in DuckDB SQL, its rounds written out."""
    rest = lambda u: f"CASE WHEN strpos({u}, '://') > 0 THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END"
    host = lambda u: f"translate(regexp_extract({rest(u)}, '^[^/?#]*', 0), '{UPPER}', '{LOWER}')"
    order = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    case = lambda k: "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[k]}'" for h, p, v in order) + " END"
    link = LINK.replace("'", "''")
    steps = "".join(
        f""",
s{k + 1} AS MATERIALIZED (SELECT host, kind, sum(score) AS score FROM (
  SELECT * FROM s0 UNION ALL SELECT w.dst, w.kind, {DAMPING!r} * s.score * w.w FROM s{k} s JOIN ways w ON s.host = w.host AND s.kind = w.kind) GROUP BY host, kind)"""
        for k in range(SQL_ROUNDS)
    )
    tell = lambda c: f"printf('%.{DIGITS - 1}e', {c})::DOUBLE AS {c}"
    return f"""WITH p AS (SELECT page_id, coalesce({host('url')}, '') AS host, coalesce(regexp_extract({rest('url')}, '^[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),
r AS (SELECT page_id, host, path, {case(0)} AS rule, {case(1)} AS by_rule FROM p),
seeds AS (SELECT host, count(*) FILTER (by_rule = 'allow') AS allowed, count(*) FILTER (by_rule = 'block') AS blocked FROM r WHERE by_rule IS NOT NULL GROUP BY host),
s0 AS MATERIALIZED (SELECT host, 't' AS kind, {1 - DAMPING!r} * allowed / (SELECT sum(allowed) FROM seeds) AS score FROM seeds WHERE allowed > 0
  UNION ALL SELECT host, 'd', {1 - DAMPING!r} * blocked / (SELECT sum(blocked) FROM seeds) FROM seeds WHERE blocked > 0),
u AS (SELECT host AS src, regexp_replace(translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}'), '{AFTER}', '') AS dst FROM p),
links AS (SELECT src, dst, count(*) AS n FROM u WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
arcs AS (SELECT src AS host, 't' AS kind, dst, n FROM links UNION ALL SELECT dst, 'd', src, n FROM links),
ways AS MATERIALIZED (SELECT host, kind, dst, n / sum(n) OVER (PARTITION BY host, kind) AS w FROM arcs){steps},
f AS (SELECT host, coalesce(sum(score) FILTER (kind = 't'), 0.0)::DOUBLE AS trust, coalesce(sum(score) FILTER (kind = 'd'), 0.0)::DOUBLE AS distrust FROM s{SQL_ROUNDS} GROUP BY host)
SELECT page_id, r.host, path, rule, coalesce(by_rule, CASE WHEN distrust > {RATIO * (1 + TOLERANCE)!r} * trust THEN 'block' ELSE 'allow' END) AS verdict, {tell('trust')}, {tell('distrust')}
FROM r LEFT JOIN f ON r.host = f.host"""
