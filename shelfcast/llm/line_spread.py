"""Line dedup by distinct-site spread: lines that many sites share are boilerplate.

A HyperLogLog sketch of sites per line is made in every task that reads the line, and the
sketches merge. Lines whose estimate is far above the threshold are boilerplate, far below
they are not, and only those in between get an exact count of their sites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.common import documents, stage

# A line on this many sites is boilerplate; shorter lines are separators and stay.
SITES = 5
SHORTEST = 10
# Sketches of 2^12 cells err by 1.6 %; five times that is settled by exact counts.
SKETCH_BITS = 12
MARGIN = 0.08


def clean_line(line: Column) -> Column:
    """A line as compared: blanks trimmed and joined, A-Z lower-cased."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def line_rows(docs: DataFrame, site: str = "source", shortest: int = SHORTEST) -> DataFrame:
    """``doc_id``, ``site``, ``at``, ``line`` and ``check`` (64 and 32 bits of hash of the
    clean line) of every line that counts. A null site is a site of its own."""
    split = docs.select(
        "doc_id", F.col(site).alias("site"), F.posexplode(F.split("text", "\n")).alias("at", "_line")
    )
    clean = split.withColumn("_clean", clean_line(F.col("_line"))).where(F.length("_clean") >= shortest)
    return clean.select("doc_id", "site", "at", F.xxhash64("_clean").alias("line"), F.crc32("_clean").alias("check"))


def sites_about(site: Column) -> Column:
    """Estimated number of different values, from sketches that merge."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(site, SKETCH_BITS))


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """``line`` and ``check`` of the lines on at least ``sites`` sites.

    Every row of a line feeds its sketch, in the task that reads it, so a line on a third
    of all pages reaches the merge as one sketch per task. Lines that occur fewer times
    than ``sites`` cannot be on so many. Only lines whose estimate is near ``sites`` have
    their sites counted, of rows merged to one per line and site first.
    """
    key = ["line", "check"]
    named = F.coalesce(F.concat(F.lit("s"), "site"), F.lit("-")).alias("site")
    named_lines = lines.select(*key, named)
    sketched = named_lines.groupBy(*key).agg(sites_about(F.col("site")).alias("_about"), F.count("*").alias("_rows"))
    low, high = sites * (1 - MARGIN), sites * (1 + MARGIN)
    sketched = stage(sketched.where((F.col("_rows") >= sites) & (F.col("_about") >= low)).drop("_rows"), "sketched")
    sure = sketched.where(F.col("_about") > high).select(*key)
    near = sketched.where(F.col("_about") <= high).select(*key)
    on_site = named_lines.groupBy(*key, "site").agg(F.count("*").alias("_n"))
    exact = on_site.join(near, key, "left_semi").groupBy(*key).agg(F.count("*").alias("_sites"))
    return sure.unionAll(exact.where(F.col("_sites") >= sites).select(*key))


def removed_lines(docs: DataFrame, site: str = "source", sites: int = SITES, shortest: int = SHORTEST) -> DataFrame:
    """``doc_id`` and ``removed`` (positions of the lines that go) of documents that lose any.

    Of each boilerplate line the occurrence in the document with the smallest id, and in it
    the first, stays, so no text is lost altogether.
    """
    lines = stage(line_rows(docs, site, shortest), "lines")
    common = stage(boilerplate(lines, sites), "boilerplate")
    hits = lines.join(common, ["line", "check"])
    first = hits.groupBy("line", "check").agg(F.min(F.struct("doc_id", "at")).alias("_first"))
    kept = first.select(F.col("_first.doc_id").alias("doc_id"), F.col("_first.at").alias("at"), "line", "check")
    gone = hits.join(kept, ["doc_id", "at", "line", "check"], "left_anti")
    return gone.groupBy("doc_id").agg(F.collect_set("at").alias("removed"))


def without_boilerplate(
    docs: DataFrame, site: str = "source", sites: int = SITES, shortest: int = SHORTEST
) -> DataFrame:
    """``docs`` with the boilerplate lines cut from ``text``, and ``n_lines``, ``n_removed``.

    Every row stays. Lines end at ``\\n``; lines shorter than ``shortest`` characters, once
    blanks are joined, stay. A null text stays null with no lines, an empty one has one
    line. Rows without an id never lose lines. Repeated rows of one id lose the same lines.
    Columns called ``n_lines`` or ``n_removed`` are replaced, others stay.
    """
    gone = removed_lines(docs.where("doc_id IS NOT NULL"), site, sites, shortest)
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("removed").alias("_removed"))
    cut = F.array_join(
        F.filter(F.split("text", "\n"), lambda _, at: ~F.array_contains("_removed", at)), "\n"
    )
    return (
        docs.drop("n_lines", "n_removed")
        .join(gone, F.col("doc_id") == F.col("_id"), "left")
        .withColumns(
            {
                "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))),
                "n_removed": F.coalesce(F.array_size("_removed"), F.lit(0)),
                "text": F.when(F.col("_removed").isNull(), F.col("text")).otherwise(cut),
            }
        )
        .drop("_id", "_removed")
    )


def query(spark, sf_dir):
    cleaned = without_boilerplate(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH split AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place
  FROM documents
),
clean AS (
  SELECT doc_id, source, place, line,
         trim(regexp_replace(lower(line), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS clean
  FROM split
),
common AS (
  SELECT clean FROM clean WHERE length(clean) >= {SHORTEST} GROUP BY clean
  HAVING count(DISTINCT coalesce('s' || source, '-')) >= {SITES}
),
marked AS (
  SELECT c.doc_id, c.place, c.line,
         k.clean IS NOT NULL AND row_number() OVER (PARTITION BY c.clean ORDER BY c.doc_id, c.place) > 1 AS gone
  FROM clean c LEFT JOIN common k ON k.clean = c.clean
),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines,
       CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(kept) END AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
