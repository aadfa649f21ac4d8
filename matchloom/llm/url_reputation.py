"""URL filter by empirical-Bayes host reputation, in DataFrame operations.

Labelled pages are counted by host, registered domain and suffix. From suffix to domain to host each level's share of bad pages
is a beta-binomial posterior whose prior has the parent's mean and a strength estimated by moments from that level's spread.
A host is blocked when even the lower bound of its share is above `most_bad`. Hosts without labels inherit their domain's
posterior, or the suffix's, or the overall share. Fixed rules go first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

# Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Suffixes of two parts; every other suffix is the last part.
TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.za")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"://([^/?#]*)([^?#]*)"
STRONGEST = 1000.0


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, SPLIT, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def host_suffix(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_PART_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def host_domain(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_PART_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def best_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule whose host is the url's or above it, and whose path the url's begins with; and its verdict."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in reversed(longest_first):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def strength(groups: DataFrame, mean: float) -> float:
    """Prior strength of a level from (n, bad) rows: moments of the beta-binomial, between 1 and STRONGEST."""
    r = groups.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n") * F.col("n")), F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - mean, F.lit(2.0)))).first()
    j, n, squares, spread = r[0] or 0, float(r[1] or 0), float(r[2] or 0), r[3] or 0.0
    room = mean * (1 - mean) * (n - squares / n - (j - 1)) if n else 0.0
    rho = (spread - mean * (1 - mean) * (j - 1)) / room if room > 0 else 0.0
    return max(1.0, min(STRONGEST, (1 - rho) / rho)) if rho > 0 else STRONGEST


def reputations(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", label_id: str = "doc_id", good: str = "quality") -> tuple[DataFrame, DataFrame, DataFrame, float, float]:
    """Posterior (alpha, beta) rows of hosts, domains and suffixes, and the overall share of bad pages with its strength."""
    lab = labels.select(F.col(label_id).alias("id"), (1 - F.col(good).cast("long")).alias("bad")).where("id is not null and bad in (0, 1)")
    lab = lab.groupBy("id").agg(F.max("bad").alias("bad"))
    host = pages.select(F.col(page_id).alias("id"), url_host(F.col(url)).alias("host"))
    hosts = C.stored(host.join(lab, "id").where("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")).withColumn("domain", host_domain(F.col("host"))).withColumn("suffix", host_suffix(F.col("host"))))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    mean = (bad + 1.0) / (n + 2.0) if n else 0.5
    ks, kd, kh = (strength(x, mean) for x in (suffixes, domains, hosts))

    def posterior(df: DataFrame, parent: Column, k: float, key: str) -> DataFrame:
        return df.select(key, (k * parent + F.col("bad")).alias("alpha"), (k * (1 - parent) + F.col("n") - F.col("bad")).alias("beta"))

    share = F.col("p.alpha") / (F.col("p.alpha") + F.col("p.beta"))
    s = posterior(suffixes, F.lit(mean), ks, "suffix")
    d = posterior(domains.join(s.alias("p"), "suffix"), share, kd, "domain")
    h = posterior(hosts.join(d.alias("p"), "domain"), share, kh, "host")
    return C.stored(h), C.stored(d), C.stored(s), mean, ks


def filter_urls(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, most_bad: float = 0.5, z: float = 1.645) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_share, bad_lower), one row for each input row.

    Null urls and urls without "://" have an empty host and path and take the overall share; null ids have no label;
    repeated pages count each; of several labels of an id the worse counts; an empty table gives no rows; without labels the
    share is a half. Extra columns are not read."""
    h, d, s, mean, k = reputations(pages, labels, page_id, url)
    x = pages.select(F.col(page_id).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    x = x.withColumn("domain", host_domain(F.col("host"))).withColumn("suffix", host_suffix(F.col("host")))
    x = x.join(h.withColumnsRenamed({"alpha": "ha", "beta": "hb"}), "host", "left").join(d.withColumnsRenamed({"alpha": "da", "beta": "db"}), "domain", "left").join(s.withColumnsRenamed({"alpha": "sa", "beta": "sb"}), "suffix", "left")
    a, b = F.coalesce("ha", "da", "sa", F.lit(k * mean)), F.coalesce("hb", "db", "sb", F.lit(k * (1 - mean)))
    share = a / (a + b)
    lower = share - z * F.sqrt(share * (1 - share) / (a + b + 1))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    return x.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(lower > most_bad, "block").otherwise("allow")).alias("verdict"), share.alias("bad_share"), lower.alias("bad_lower"))


TWO_SQL = ", ".join(f"'{x}'" for x in TWO_PART_SUFFIXES)
SQL = rf"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host, coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
v AS (SELECT *, string_split(host, '.') AS q, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS two FROM u),
x AS (SELECT page_id, host, path, CASE WHEN two IN ({TWO_SQL}) THEN two ELSE q[-1] END AS suffix,
  CASE WHEN two IN ({TWO_SQL}) THEN array_to_string(list_slice(q, -3, -1), '.') ELSE two END AS domain FROM v),
l AS (SELECT doc_id AS id, max(1 - quality) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY doc_id),
h AS (SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS bad FROM x JOIN l ON x.page_id = l.id WHERE host <> '' GROUP BY ALL),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
m AS (SELECT CASE WHEN count(*) > 0 THEN (sum(bad) + 1.0) / (sum(n) + 2.0) ELSE 0.5 END::DOUBLE AS m FROM h),
g AS (SELECT 'h' AS lev, n, bad FROM h UNION ALL SELECT 'd', n, bad FROM d UNION ALL SELECT 's', n, bad FROM s),
r AS (SELECT lev, (sum(n * pow(bad / n - m, 2)) - any_value(m * (1 - m)) * (count(*) - 1)) AS top, any_value(m * (1 - m)) * (sum(n) - sum(n * n) / sum(n) - (count(*) - 1)) AS room FROM g, m GROUP BY lev),
k AS (SELECT lev, CASE WHEN room > 0 AND top > 0 THEN greatest(1.0::DOUBLE, least(1000.0::DOUBLE, (1 - top / room) / (top / room))) ELSE 1000.0::DOUBLE END AS k FROM r),
kk AS (SELECT coalesce(max(k) FILTER (lev = 's'), 1000.0) AS ks, coalesce(max(k) FILTER (lev = 'd'), 1000.0) AS kd, coalesce(max(k) FILTER (lev = 'h'), 1000.0) AS kh FROM k),
ps AS (SELECT suffix, ks * m + bad AS a, ks * (1 - m) + n - bad AS b FROM s, m, kk),
pd AS (SELECT domain, kd * (p.a / (p.a + p.b)) + bad AS a, kd * (1 - p.a / (p.a + p.b)) + n - bad AS b FROM d JOIN ps p USING (suffix), kk),
ph AS (SELECT host, kh * (p.a / (p.a + p.b)) + bad AS a, kh * (1 - p.a / (p.a + p.b)) + n - bad AS b FROM h JOIN pd p USING (domain), kk),
e AS (SELECT x.*, coalesce(ph.a, pd.a, ps.a, ks * m) AS a, coalesce(ph.b, pd.b, ps.b, ks * (1 - m)) AS b
  FROM x LEFT JOIN ph ON x.host = ph.host LEFT JOIN pd ON x.domain = pd.domain LEFT JOIN ps ON x.suffix = ps.suffix, m, kk),
f AS (SELECT *, CASE
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM e)
SELECT page_id, host, path, rule, CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block' WHEN 'org/fr/' THEN 'allow' WHEN 'net/' THEN 'block'
  ELSE CASE WHEN a / (a + b) - 1.645 * sqrt((a / (a + b)) * (1 - a / (a + b)) / (a + b + 1)) > 0.5 THEN 'block' ELSE 'allow' END END AS verdict FROM f
"""
