"""Operator 5, URL filters: rules by host and path, and for pages without a
rule a verdict from the link graph.

Trust is personalised PageRank from hosts with allowed pages along host edges;
distrust runs from hosts with blocked pages along the reversed edges.  A host
is blocked if distrust is more than ``limit`` of trust and distrust together; a
host that neither reaches is allowed.  All of it is DataFrame operations.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and is allowed; a null html has no links; links inside one host
don't count; repeated rows each give a row and count each; other columns are
ignored.  Without edges the scores are those of the seeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import table, written
from cartwheel.llm.registry import query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING, ROUNDS, LIMIT = 0.85, 20, 0.5
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))



def host_path(url_col: str = "url") -> tuple[Column, Column]:
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_column(rules: tuple[Rule, ...], host: str = "host", path: str = "path", value: str = "name") -> Column:
    """The longest rule that fits, as a chain over the given (bounded) list."""
    chain = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        fits = ((F.col(host) == r.host) | F.col(host).endswith("." + r.host)) & F.col(path).startswith(r.path)
        chain = F.when(fits, F.lit(getattr(r, value))).otherwise(chain)
    return chain


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst, weight): links between different hosts; ``pages`` has ``host``."""
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(LINK), 1)
    rows = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(links).alias("dst"))
    return (rows.withColumn("dst", F.translate("dst", UPPER, LOWER)).where("src <> dst")
            .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")))


def propagate(edges: DataFrame, seeds: DataFrame, score: str, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """Personalised PageRank: ``seeds`` (host, seed; sums to 1) spread along the
    weighted edges for ``rounds`` rounds; (host, score) for all hosts reached."""
    if edges.isEmpty() or seeds.isEmpty():
        return seeds.select("host", ((1 - damping) * F.col("seed")).alias(score))
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    share = written(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")))
    base = seeds.select("host", ((1 - damping) * F.col("seed")).alias("r"))
    rank = base
    for i in range(rounds):
        moved = (rank.join(share, rank["host"] == share["src"])
                 .select(F.col("dst").alias("host"), (damping * F.col("r") * F.col("share")).alias("r")))
        rank = base.unionByName(moved).groupBy("host").agg(F.sum("r").alias("r"))
        if i % 4 == 3:
            rank = written(rank)
    return rank.withColumnRenamed("r", score)


def host_scores(pages: DataFrame, html_col: str = "html", damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) from pages with ``host`` and ``by_rule``."""
    edges = written(host_edges(pages, html_col))
    seen = written(pages.where("host <> ''").groupBy("host").agg(
        F.count(F.when(F.col("by_rule") == "allow", 1)).alias("allow"), F.count(F.when(F.col("by_rule") == "block", 1)).alias("block")))
    sums = seen.agg(F.sum("allow").alias("a"), F.sum("block").alias("b")).first()
    good = seen.where("allow > 0").select("host", (F.col("allow") / F.lit(max(1, sums.a or 0))).alias("seed"))
    bad = seen.where("block > 0").select("host", (F.col("block") / F.lit(max(1, sums.b or 0))).alias("seed"))
    trust = propagate(edges, good, "trust", damping, rounds)
    distrust = propagate(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"), bad, "distrust", damping, rounds)
    return trust.join(distrust, "host", "full").fillna(0.0, ["trust", "distrust"])


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url_col: str = "url", html_col: str = "html", limit: float = LIMIT,
          damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``pages`` (its columns but html) with host, path, rule, trust, distrust, verdict."""
    host, path = host_path(url_col)
    own = [c for c in pages.columns if c not in (html_col, "host", "path", "rule", "by_rule", "trust", "distrust", "verdict")]
    seen = pages.withColumns({"host": host, "path": path})
    seen = seen.withColumns({"rule": rule_column(rules), "by_rule": rule_column(rules, value="verdict")})
    scores = written(host_scores(seen, html_col, damping, rounds))
    spam = F.coalesce(F.col("distrust"), F.lit(0.0)) > limit * (F.coalesce(F.col("trust"), F.lit(0.0)) + F.coalesce(F.col("distrust"), F.lit(0.0)))
    verdict = F.coalesce(F.col("by_rule"), F.when(spam, "block").otherwise("allow"))
    return (seen.select(*own, "host", "path", "rule", "by_rule").join(scores, "host", "left")
            .select(*own, "host", "path", "rule", "trust", "distrust", verdict.alias("verdict")))


def _steps(edges: str, seed: str, name: str) -> str:
    """The rounds as SQL, written out one after another."""
    out = [f"{name}0 AS (SELECT host, {1 - DAMPING!r} * seed AS r FROM {seed})"]
    for i in range(ROUNDS):
        out.append(f"{name}{i + 1} AS (SELECT host, sum(r) AS r FROM (SELECT * FROM {name}0 UNION ALL SELECT e.dst, {DAMPING!r} * p.r * e.share "
                   f"FROM {name}{i} p JOIN {edges} e ON p.host = e.src) GROUP BY host)")
    return ",\n".join(out)


_LONGEST = "ORDER BY length(name) DESC, length(rhost) DESC, name DESC"
OP5_SQL = f"""
WITH u AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(by_rule, rhost, rpath, name) AS (VALUES {', '.join(f"('{r.verdict}', '{r.host}', '{r.path}', '{r.name}')" for r in RULES)}),
p AS (SELECT hp.*, (SELECT list(name {_LONGEST})[1] FROM rules WHERE (hp.host = rhost OR ends_with(hp.host, '.' || rhost)) AND starts_with(hp.path, rpath)) AS rule,
             (SELECT list(by_rule {_LONGEST})[1] FROM rules WHERE (hp.host = rhost OR ends_with(hp.host, '.' || rhost)) AND starts_with(hp.path, rpath)) AS by_rule FROM hp),
l AS (SELECT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '(?i)\\bhref\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\\s>]+)', 1)),
             '{UPPER}', '{LOWER}') AS dst FROM p WHERE host <> ''),
e AS (SELECT src, dst, count(*)::DOUBLE AS weight FROM l WHERE src <> dst GROUP BY ALL),
ef AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS share FROM e),
er AS (SELECT dst AS src, src AS dst, weight / sum(weight) OVER (PARTITION BY dst) AS share FROM e),
s AS (SELECT host, count(*) FILTER (by_rule = 'allow') AS a, count(*) FILTER (by_rule = 'block') AS b FROM p WHERE host <> '' GROUP BY host),
ga AS (SELECT host, a / (SELECT sum(a) FROM s) AS seed FROM s WHERE a > 0),
gb AS (SELECT host, b / (SELECT sum(b) FROM s) AS seed FROM s WHERE b > 0),
{_steps('ef', 'ga', 't')},
{_steps('er', 'gb', 'd')},
v AS (SELECT host, coalesce(t.r, 0) AS trust, coalesce(d.r, 0) AS distrust FROM t{ROUNDS} t FULL JOIN d{ROUNDS} d USING (host))
SELECT page_id, p.host, path, rule,
       coalesce(by_rule, CASE WHEN coalesce(distrust, 0) > {LIMIT} * (coalesce(trust, 0) + coalesce(distrust, 0)) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN v ON p.host = v.host"""


@query("op5_url_filter", OP5_SQL)
def op5(spark, sf_dir):
    """Verdict on every page."""
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
