"""Line dedup by site-relative frequency: a line that stands on too large a share of a host's pages is boilerplate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.llm.common import free_prefix, listed, stored, table, unlisted

#: A line goes when it stands on more than this share of its host's pages.
RATIO = 0.1
#: On fewer different pages than this a share says nothing.
MIN_PAGES = 5


def distinct_pages(pages: DataFrame) -> DataFrame:
    """``host, text`` once for each text that a host has, whatever its number of copies; null texts are no pages.

    Copies are found by hashes alone, so of the texts only those that stand more than once are shuffled, one of each
    for a task.
    """
    hashed = pages.where("text IS NOT NULL").withColumns({"h": F.xxhash64("host", "text"), "g": F.xxhash64(F.lit("g"), "text")})
    copies = stored(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "copied-pages")
    once = listed(hashed, copies, "h").groupBy("host", "h", "g").agg(F.first("text").alias("text")).select("host", "text")
    return unlisted(hashed, copies, "h").select("host", "text").union(once)


def boilerplate_lines(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source") -> DataFrame:
    """``host, lines``: per host the hashes of the lines that exceed ``ratio``.

    Counts are combined before the shuffle, so a host with a third of all pages sends no more than its distinct
    lines. A host has at most (mean distinct lines of a page) / ``ratio`` such lines, however many pages it has.
    """
    pages = distinct_pages(docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), "text"))
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: x != ""), lambda x: F.xxhash64(x)))
    # The number of pages travels as one more line, which no text has.
    lines = F.array_append(lines, F.lit(None).cast("long"))
    counts = pages.select("host", F.explode(lines).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts.where((F.col("n") >= min_pages) | F.col("line").isNull()), "line-counts")
    totals = counts.where("line IS NULL").select("host", F.col("n").alias("pages"))
    counts = counts.where("line IS NOT NULL").join(totals, "host")
    return counts.where(F.col("n") > F.lit(ratio) * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(
    docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host: str = "source", counts: bool = False
) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``; with ``counts`` also ``n_lines`` and ``n_dropped``.

    A page is a distinct text of a host: copies of it weigh once, or a group of copies would take all its own lines for
    boilerplate. A line is what stands between line breaks, compared exactly; each page counts a line once. A line is
    dropped, wherever it stands on the host's pages, when it is on at least ``min_pages`` of them (on a few pages a
    share says nothing) and on more than ``ratio`` of all; one exactly at the ratio stays. Empty lines are never
    dropped. A null host is the host with the empty name. A null text stays null, has no lines and is no page. The
    other columns stay as they are.
    """
    p = free_prefix(docs)
    own = docs.withColumn(f"{p}host", F.coalesce(F.col(host).cast("string"), F.lit("")))
    known = stored(boilerplate_lines(docs, ratio, min_pages, host), "boilerplate").select(
        F.col("host").alias(f"{p}host"), F.col("lines").alias(f"{p}lines")
    )
    known = own.join(known, f"{p}host", "left").withColumn(f"{p}split", F.split("text", "\n"))
    known = known.withColumn(
        f"{p}kept",
        F.when(F.col(f"{p}lines").isNull(), F.col(f"{p}split")).otherwise(
            F.filter(f"{p}split", lambda x: (x == "") | ~F.array_contains(f"{p}lines", F.xxhash64(x)))
        ),
    )
    out = [F.array_join(f"{p}kept", "\n").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        n = F.coalesce(F.size(f"{p}split"), F.lit(0)).cast("long")
        n = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(n)
        out += [n.alias("n_lines"), (n - F.when(F.col("text").isNull(), 0).otherwise(F.size(f"{p}kept"))).cast("long").alias("n_dropped")]
    return known.select(*out)


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, counts=True).select("doc_id", "n_lines", "n_dropped", "text")


OP10_SQL = f"""
WITH split AS (SELECT doc_id, coalesce(source, '') AS host, text, string_split(text, chr(10)) AS lines FROM documents),
pages AS (SELECT DISTINCT host, text, lines FROM split WHERE text IS NOT NULL),
totals AS (SELECT host, count(*) AS pages FROM pages GROUP BY host),
counts AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM pages)
           WHERE line <> '' GROUP BY host, line),
boiler AS (SELECT host, list(line) AS gone FROM counts JOIN totals USING (host)
           WHERE n >= {MIN_PAGES} AND n > {RATIO}::DOUBLE * pages GROUP BY host),
kept AS (SELECT doc_id, text, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), x)) AS rest
         FROM split LEFT JOIN boiler USING (host))
SELECT doc_id, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(rest), 0) AS n_dropped,
       CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(rest, chr(10)), '') END AS text FROM kept
"""
