"""URL filter by empirical-Bayes host reputation, DataFrame functions only.

Labelled page outcomes (blocked or allowed) are counted by host, registered domain (the last
two labels) and suffix (the last). Each level has a beta prior: its mean is the posterior mean
one level up, its strength comes from how much the level's rates differ from those means beyond
binomial noise (method of moments), and is no more than what the level up is itself known with. A host is blocked where the lower bound of its posterior
blocked rate is above one half.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstick.llm.common import lower_az, salted_join, store, table

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
Z = 1.645  # posterior standard deviations below the mean
LIMIT = 0.5
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    text = F.coalesce(url, F.lit(""))
    return lower_az(F.regexp_extract(text, URL, 1)), F.regexp_extract(text, URL, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls. Rules are a short list kept in the plan."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame, n: str, k: str, mean: str) -> Column:
    """Prior strength from children's counts and their prior means, as a scalar."""
    c = children.where(F.col(n) > 0)
    noise = F.sum(F.col(mean) * (1 - F.col(mean)))
    spread = F.sum(F.col(n) * F.pow(F.col(k) / F.col(n) - F.col(mean), 2))
    more = F.sum(F.col(mean) * (1 - F.col(mean)) * (F.col(n) - 1))
    rho = F.coalesce(F.try_divide(spread - noise, more), F.lit(0.5))
    rho = F.least(F.greatest(rho, F.lit(0.001)), F.lit(0.999))
    return c.agg(((1 - rho) / rho).alias("s")).scalar()


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """host, n, blocked, mean and bound for every host of outcomes (host, blocked boolean or null).

    A host without outcomes gets its domain's mean with the prior's width; with no outcomes at all the
    overall mean is one half. The host table has one row per host; counts are partial sums.
    """
    hosts = outcomes.groupBy("host").agg(F.count("blocked").alias("n"), F.count_if(F.col("blocked")).alias("k"))
    site = F.regexp_replace("host", ":[0-9]*$", "")
    hosts = store(hosts.select("host", F.substring_index(site, ".", -2).alias("domain"),
                               F.substring_index(site, ".", -1).alias("suffix"), "n", "k"), "hosts")
    total = hosts.agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("p")).scalar()
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("ns"), F.sum("k").alias("ks"))
    suffixes = suffixes.withColumn("p0", F.coalesce(total, F.lit(0.5)))
    s1 = _strength(suffixes, "ns", "ks", "p0")
    suffixes = store(suffixes.select("suffix", ((F.col("ks") + s1 * F.col("p0")) / (F.col("ns") + s1)).alias("ps"),
                                     (F.col("ns") + s1).alias("es")), "suffixes")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("nd"), F.sum("k").alias("kd"))
    domains = store(salted_join(domains, suffixes, ["suffix"], ["domain"]), "domains")
    domains = domains.withColumn("s2", 1 / (1 / _strength(domains, "nd", "kd", "ps") + 1 / F.col("es")))
    domains = domains.select("domain", ((F.col("kd") + F.col("s2") * F.col("ps")) / (F.col("nd") + F.col("s2"))).alias("pd"),
                             (F.col("nd") + F.col("s2")).alias("ed"))
    hosts = store(salted_join(hosts, domains, ["domain"], ["host"]), "hosts")
    hosts = hosts.withColumn("s3", 1 / (1 / _strength(hosts, "n", "k", "pd") + 1 / F.col("ed")))
    s3 = F.col("s3")
    hosts = hosts.withColumn("a", F.col("k") + s3 * F.col("pd")).withColumn("b", F.col("n") - F.col("k") + s3 * (1 - F.col("pd")))
    ab = F.col("a") + F.col("b")
    hosts = hosts.withColumn("mean", F.col("a") / ab)
    return hosts.select("host", "n", F.col("k").alias("blocked"), "mean",
                        (F.col("mean") - z * F.sqrt(F.col("a") * F.col("b") / (ab * ab * (ab + 1)))).alias("bound"))


def filter_urls(pages: DataFrame, rules=RULES, z: float = Z, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, host_mean, host_bound per row of pages (page_id, url).

    Where a rule fits, it decides, and the page is a labelled outcome of its host; elsewhere the
    host's reputation does: block if host_bound > limit. A null url, or one without ://, has an
    empty host and path, judged as a host of its own. Repeated rows are judged alike and each count.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("__v"))
    known = host_reputation(rows.select("host", (F.col("__v") == "block").alias("blocked")), z)
    joined = salted_join(rows, known.select("host", "mean", "bound"), ["host"], ["page_id", "path"])
    by_host = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("__v", by_host).alias("verdict"),
                         F.round("mean", 6).alias("host_mean"), F.round("bound", 6).alias("host_bound"))


def op3_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages' urls under the fixed rules."""
    return filter_urls(table(spark, sf_dir, "pages"))


def _oracle() -> str:
    def fits(text: str) -> str:
        name, slash, rest = text.partition("/")
        return f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + rest}')"

    order = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    rule = " ".join(f"WHEN {fits(t)} THEN '{t}'" for _, t in order)
    verdict = " ".join(f"WHEN rule = '{t}' THEN '{v}'" for v, t in order)

    def strength(n, k, mean, src):
        return (f"SELECT (1 - rho) / rho AS s FROM (SELECT least(greatest(coalesce((sum({n} * pow({k} / {n} - {mean}, 2)) - "
                f"sum({mean} * (1 - {mean}))) / nullif(sum({mean} * (1 - {mean}) * ({n} - 1)), 0), 0.5), 0.001), 0.999) AS rho "
                f"FROM {src} WHERE {n} > 0)")

    return f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS t FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(t, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(t, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM u),
ru AS (SELECT *, CASE {rule} END AS rule FROM hp),
ve AS (SELECT *, CASE {verdict} END AS says FROM ru),
h0 AS (SELECT host, regexp_replace(host, ':[0-9]*$', '') AS site, count(says) AS n, count(*) FILTER (says = 'block') AS k
       FROM ve GROUP BY host),
h AS (SELECT host, n, k, regexp_extract(site, '([^.]*[.])?[^.]*$', 0) AS domain,
      regexp_extract(site, '[^.]*$', 0) AS suffix FROM h0),
s0 AS (SELECT suffix, sum(n) AS ns, sum(k) AS ks, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM h) AS p0 FROM h GROUP BY suffix),
s1 AS ({strength('ns', 'ks', 'p0', 's0')}),
sx AS (SELECT suffix, (ks + (SELECT s FROM s1) * p0) / (ns + (SELECT s FROM s1)) AS ps, ns + (SELECT s FROM s1) AS es FROM s0),
d0 AS (SELECT domain, suffix, sum(n) AS nd, sum(k) AS kd FROM h GROUP BY domain, suffix),
d1 AS (SELECT d0.*, ps, es FROM d0 JOIN sx USING (suffix)),
s2 AS ({strength('nd', 'kd', 'ps', 'd1')}),
d2 AS (SELECT *, 1 / (1 / (SELECT s FROM s2) + 1 / es) AS t FROM d1),
dx AS (SELECT domain, (kd + t * ps) / (nd + t) AS pd, nd + t AS ed FROM d2),
h1 AS (SELECT h.*, pd, ed FROM h JOIN dx USING (domain)),
s3 AS ({strength('n', 'k', 'pd', 'h1')}),
h2 AS (SELECT *, 1 / (1 / (SELECT s FROM s3) + 1 / ed) AS t FROM h1),
hb AS (SELECT host, k + t * pd AS a, n - k + t * (1 - pd) AS b FROM h2),
hx AS (SELECT host, a / (a + b) AS mean, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM hb)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN bound > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       round(mean, 6) AS host_mean, round(bound, 6) AS host_bound
FROM ve JOIN hx USING (host)"""


OP3_SQL = _oracle()
