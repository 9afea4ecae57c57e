"""URL filter by empirical-Bayes host reputation: outcomes of labelled pages, shrunk from host to domain to suffix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.llm.common import stored, table

#: (host, path, verdict), as the contract of the query fixes them.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: A host is blocked when its share of bad pages is above this with posterior probability of about 95 %.
BAD_SHARE = 0.3
BOUND = 1.645
#: Range of a prior's weight in pages, where the counts determine none.
LIGHTEST, HEAVIEST = 1.0, 1000.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substr(url, at + 3), "^([^/?#]*)", 1)
    return F.when(at > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def url_path(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), "^[^/?#]*([^?#]*)", 1)).otherwise("")


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none does. Rules are configuration, a few dozen."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def case(value):
        def add(found, rule):
            name, start, verdict = rule
            fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
            return found.when(fits, value(name, start, verdict))

        return reduce(add, ordered, F.when(F.lit(False), F.lit(None).cast("string")))

    return case(lambda n, p, v: n + p), case(lambda n, p, v: v)


def _prior(counts: DataFrame, parent: DataFrame, by: str) -> float:
    """Weight of a level's beta prior, by moments: how much rates differ beyond what their counts explain."""
    with_mean = counts.join(parent.select(by, F.col("mean").alias("m")), by)
    row = with_mean.agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), F.lit(2))).alias("spread"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("noise"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("typical"),
    ).first()
    if not row["n"]:
        return LIGHTEST
    if row["spread"] <= row["noise"]:
        return HEAVIEST
    between = (row["spread"] - row["noise"]) / row["n"]
    return min(HEAVIEST, max(LIGHTEST, row["typical"] / row["n"] / between - 1))


def host_reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, bad_mean, bad_low`` for every host of ``pages (page_id, url)``.

    ``labels (doc_id, quality, toxic)`` tell the outcome of the page with that number: bad when toxic or of quality
    0. Beta-binomial shrinkage: the rate of a suffix (last label of the host) is drawn to that of all pages, a
    registered domain's (last two labels) to its suffix's, a host's to its domain's, each with a weight estimated
    from how much the rates of that level differ. ``bad_low`` is the posterior's lower bound.

    Labels without a page, and pages without a label, add nothing; a host without labelled pages has its domain's
    rate. A label with both values null counts as good; a page labelled more than once counts each time.
    """
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"))
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("long")
    judged = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    seen = urls.join(judged, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    parts = F.split("host", "[.]")
    seen = seen.select(
        "host",
        F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), ".").alias("domain"),
        F.element_at(parts, -1).alias("suffix"),
        "n",
        "bad",
    )
    seen = stored(seen, "hosts")
    total = seen.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)

    suffixes = seen.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    flat = suffixes.select("suffix", F.lit(overall).alias("mean"))
    labelled = F.col("n") > 0

    def shrunk(counts: DataFrame, parent: DataFrame, by: str, keys: list[str]) -> tuple[DataFrame, float]:
        k = _prior(counts.where(labelled), parent, by)
        joined = counts.join(parent.select(by, F.col("mean").alias("m")), by)
        return joined.select(*keys, "n", ((F.col("bad") + k * F.col("m")) / (F.col("n") + k)).alias("mean")), k

    by_suffix, _ = shrunk(suffixes, flat, "suffix", ["suffix"])
    domains = seen.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    by_domain, _ = shrunk(domains, by_suffix, "suffix", ["domain"])
    by_host, k = shrunk(seen, by_domain, "domain", ["host"])
    mean = F.col("mean")
    low = mean - BOUND * F.sqrt(mean * (1 - mean) / (F.col("n") + k + 1))
    return by_host.select("host", mean.alias("bad_mean"), low.alias("bad_low"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, bad_share: float = BAD_SHARE) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_mean, bad_low`` for each row of ``pages (page_id, url)``.

    The longest rule that fits the host (or a domain above it) and the start of the path decides; else the page is
    blocked when the lower posterior bound of its host's share of bad pages is above ``bad_share``. A null url or one
    without ``://`` has an empty host and path, fits no rule and is judged as the empty host. Repeated rows are judged
    each; an empty table gives none; without labels every host has the rate one half, and a bound far below it.
    """
    named = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    known = named.join(host_reputation(pages, labels), "host", "left")
    method = F.when(F.col("bad_low") > bad_share, "block").otherwise("allow")
    return known.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "bad_mean", "bad_low")


def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("bad_mean", 9).alias("bad_mean"))


def _level(name: str, counts: str, parent: str, by: str) -> str:
    return f"""
p_{name} AS (SELECT sum(n * pow(bad / n - mean, 2)) AS spread, sum(mean * (1 - mean)) AS noise, sum(n) AS total,
                    sum(n * mean * (1 - mean)) AS typical
             FROM {counts} JOIN (SELECT {by}, mean FROM {parent}) USING ({by}) WHERE n > 0),
k_{name} AS (SELECT CASE WHEN coalesce(total, 0) = 0 THEN {LIGHTEST}::DOUBLE WHEN spread <= noise THEN {HEAVIEST}::DOUBLE
                    ELSE least({HEAVIEST}::DOUBLE, greatest({LIGHTEST}::DOUBLE,
                         typical / total / ((spread - noise) / total) - 1)) END AS k FROM p_{name}),
m_{name} AS (SELECT c.*, (c.bad + (SELECT k FROM k_{name}) * q.mean) / (c.n + (SELECT k FROM k_{name})) AS mean
             FROM {counts} c JOIN (SELECT {by}, mean FROM {parent}) q USING ({by}))"""


OP4_SQL = f"""
WITH urls AS (SELECT page_id, CASE WHEN coalesce(strpos(url, '://'), 0) > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
named AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM urls),
judged AS (SELECT doc_id AS page_id, CAST(coalesce(quality = 0, false) OR coalesce(toxic = 1, false) AS INT) AS bad FROM labels),
hosts AS (SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
                 list_extract(string_split(host, '.'), -1) AS suffix,
                 count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad
          FROM named LEFT JOIN judged USING (page_id) GROUP BY host),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix),
flat AS (SELECT suffix, (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) FROM hosts) AS mean FROM suffixes),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
{_level("s", "suffixes", "flat", "suffix")},
{_level("d", "domains", "m_s", "suffix")},
{_level("h", "hosts", "m_d", "domain")},
ruled AS (SELECT page_id, host, path, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM named)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN mean - {BOUND}::DOUBLE * sqrt(mean * (1 - mean) / (n + (SELECT k FROM k_h) + 1)) > {BAD_SHARE}::DOUBLE THEN 'block'
            ELSE 'allow' END AS verdict,
       round(mean, 9) AS bad_mean
FROM ruled JOIN m_h USING (host)
"""
