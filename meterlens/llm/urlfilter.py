"""URL filters: host-suffix and path-prefix rules by hash prefixes, DataFrame
operations only.

A rule (host, path, verdict) fits a url when its host is the url's host or a
parent domain of it and the url's path starts with the rule's path.  Each url
expands into its host suffixes (no more labels than the longest rule has)
times its path prefixes (of the lengths that rules have); every expression is
hashed, equi-joined with the rules on a short hash prefix, and confirmed on
the full digest.  Of the rules that fit, the longest wins; on equal length
the longer host, then ``block``, then the greater text.  A url that no rule
fits gets the default verdict.

Rules are broadcast when their count and bytes are proven small; else both
sides are salted, as expressions of common domains (``com/``) are hot keys.

Edge cases: a null url, or one without ``://``, has an empty host and path;
repeated rows and null ids get a row each; an empty table gives no rows; an
empty rule table leaves the default verdict; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed rules of the registered query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEFAULT = "allow"
#: Rules are broadcast up to this many rows and text bytes.
BROADCAST_RULES, BROADCAST_BYTES = 100_000, 8 << 20
#: Hex digits of the digest that the join compares first.
SHORT = 8
SALT = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and the path behind it."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    behind = F.substring(rest, F.length(host) + 1, F.length(rest) + 1)
    return (F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER),
            F.coalesce(F.regexp_extract(behind, "^[^?#]*", 0), F.lit("")))


def expressions(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """All ``suffix + prefix`` strings that a rule could be."""
    parts = F.slice(F.reverse(F.split(host, r"\.")), 1, labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda n: F.array_join(F.reverse(F.slice(parts, 1, n)), "."))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    prefixes = F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages`` (``page_id, url``)."""
    text = F.concat("host", "path")
    digest = F.sha2(text.cast("binary"), 256)
    rules = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        digest.alias("full"), F.substring(digest, 1, SHORT).alias("short"),
        F.struct(F.length(text).alias("size"), F.length("host").alias("host_size"),
                 (F.col("verdict") == "block").alias("blocks"), text.alias("rule"), F.col("verdict")).alias("found"),
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_size"))
    facts = rules.agg(F.max("labels"), F.collect_set("path_size"), F.count(F.lit(1)),
                      F.sum(F.length("found.rule") + 200)).first()
    labels, lengths, count, size = facts[0] or 1, sorted(facts[1]) or [0], facts[2], facts[3] or 0
    host, path = host_and_path(F.col("url"))
    # one number per row, so that neither a hot host nor a hot url gathers rows
    rows = pages.select("page_id", "url").select(
        "page_id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    asked = rows.select("*", F.explode_outer(expressions(F.col("host"), F.col("path"), labels, lengths)).alias("text"))
    asked = (asked.withColumn("full", F.sha2(F.col("text").cast("binary"), 256)).drop("text")
                  .withColumn("short", F.substring("full", 1, SHORT)))
    rules = rules.select(F.col("full").alias("rule_full"), "short", "found")
    if count <= BROADCAST_RULES and size <= BROADCAST_BYTES:
        got = asked.join(F.broadcast(rules), "short", "left")
    else:
        salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        got = asked.withColumn("salt", F.pmod(F.hash("row"), F.lit(SALT))).join(salted, ["short", "salt"], "left")
    sure = F.when(F.col("full") == F.col("rule_full"), F.col("found"))
    best = got.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"),
                                  F.first("path").alias("path"), F.max(sure).alias("found"))
    return best.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                       F.coalesce("found.verdict", F.lit(default)).alias("verdict"))


#: The same judgement in DuckDB SQL, by comparing every url with every rule.
ORACLE = """
WITH r(rhost, rpath, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p AS (SELECT page_id, row_number() OVER () AS n,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, n, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM p),
u AS (SELECT page_id, n, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
m AS (SELECT n, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY n
        ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, verdict DESC) AS place
    FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM m WHERE place = 1) b ON u.n = b.n
"""
