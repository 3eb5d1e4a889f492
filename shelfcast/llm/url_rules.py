"""URL filters: rules found by their rarest literal token, then run as patterns.

A rule names a host (it and all subdomains) and a path prefix. Its literal tokens are its
host labels and the path segments that a slash ends. Every rule is indexed under the one
of them that the fewest urls hold; a url fetches the rules under its own tokens, and only
those run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# (verdict, host, path prefix)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """Host after the first ``://``, A-Z lower-cased; empty without one or for null."""
    rest = _after_scheme(url)
    return F.translate(
        F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty like the host."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def tokens(host: Column, path: Column) -> Column:
    """Literal tokens: host labels, and path segments that a slash ends, each once."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.split(path, "/")
    # a path starts with a slash, so its first part is empty; its last part is not ended
    ended = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    segments = F.transform(ended, lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(labels, segments))


def pattern(host: str, path: str) -> str:
    """Regular expression of a rule over host and path put together."""
    return f"^(?:[^/]*\\.)?{re.escape(host)}{re.escape(path)}"


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    rows = [
        (verdict, host.lower() + path, host.lower(), path, pattern(host.lower(), path))
        for verdict, host, path in rules
    ]
    return spark.createDataFrame(
        rows, "verdict string, rule string, rule_host string, rule_path string, pattern string"
    )


def judge(
    pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; every row stays.

    ``rules`` has the columns of ``rule_table``. The longest fitting rule wins, ties go to
    the longer host, then to block, then to the smaller rule. Urls are judged once however
    often they occur. A null url, or one without ``://``, has empty host and path and the
    default verdict; without a fitting rule ``rule`` is null. Columns of ``pages`` with the
    names of the four results are replaced. No page gives an empty table, no rule gives
    the default everywhere.
    """
    urls = pages.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    urls = urls.select("_url", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
    url_tokens = urls.withColumn("_token", F.explode(tokens(F.col("_host"), F.col("_path"))))
    rule_tokens = rules.distinct().withColumn(
        "_token", F.explode(tokens(F.col("rule_host"), F.col("rule_path")))
    )
    used = url_tokens.join(rule_tokens.select("_token").distinct(), "_token", "left_semi")
    frequency = used.groupBy("_token").agg(F.count("*").alias("_urls"))
    rarest = F.min(F.struct(F.coalesce("_urls", F.lit(0)).alias("_urls"), "_token"))
    index = (
        rule_tokens.join(frequency, "_token", "left")
        .groupBy("verdict", "rule", "rule_host", "pattern")
        .agg(rarest["_token"].alias("_token"))
    )
    fits = url_tokens.join(index, "_token").where(
        F.regexp_like(F.concat("_host", "_path"), F.col("pattern"))
    )
    order = F.struct(
        -F.length("rule"), -F.length("rule_host"), F.col("verdict") != "block", "rule"
    )
    judged = fits.groupBy("_url").agg(F.min_by(F.struct("rule", "verdict"), order).alias("_best"))
    kept = pages.drop("host", "path", "rule", "verdict")
    page_url = F.coalesce(F.col(url), F.lit(""))
    return (
        kept.withColumns({"host": host_of(page_url), "path": path_of(page_url)})
        .join(judged, F.col(url) == F.col("_url"), "left")
        .withColumns(
            {
                "rule": F.col("_best.rule"),
                "verdict": F.coalesce("_best.verdict", F.lit(default)),
            }
        )
        .drop("_url", "_best")
    )


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


_VALUES = ", ".join(f"('{v}', '{h}{p}', '{h}', '{p}')" for v, h, p in RULES)

ORACLE_SQL = f"""
WITH rules(verdict, rule, rule_host, rule_path) AS (VALUES {_VALUES}),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
                       THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT_VERDICT}') AS verdict
FROM parts
LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, length(rule_host) DESC) = 1
"""
