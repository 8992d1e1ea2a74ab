"""URL filter: fixed rules first, then an empirical-Bayes reputation of the host.

Outcomes are labelled pages: the page whose ``page_id`` is a labelled ``doc_id``; it counts as bad if its quality is 0 or
it is toxic. Bad rates are shrunk along global rate -> suffix (last name of the host) -> registered domain (last two
names; three under a two-name suffix given by the caller) -> host. At each level the children's rates are taken as
Beta(m s, (1 - m) s) around the parent's posterior mean m; the one strength s of the level comes from the moments of the
beta-binomial over all children. A host is blocked if the lower posterior bound of its bad rate (normal approximation)
is over ``limit``; a host without labelled pages keeps its domain's mean with little certainty.

Null url or one without ``://``: host and path are empty, no rule fits, and the empty host is judged as any host.
Repeated pages give repeated rows; repeated labels of one id count once (bad if one of them is). Other columns are
ignored. Hosts are counted before anything is joined; the join back on the host has one row per host on its right, so
a hot host is split by adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frameline.llm.common import ascii_lower, keep

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
LIMIT, Z = 0.3, 1.645


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.locate("://", url)
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Verdict and text of the longest rule that fits, else null."""
    verdict, rule = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        verdict, rule = F.when(fits, F.lit(action)).otherwise(verdict), F.when(fits, F.lit(text)).otherwise(rule)
    return verdict, rule


def registered_domain(host: Column, two_name_suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    names = F.split(host, r"\.")
    pair = F.substring_index(host, ".", -2)
    long = pair.isin(list(two_name_suffixes)) if two_name_suffixes else F.lit(False)
    suffix = F.when(long, pair).otherwise(F.substring_index(host, ".", -1))
    return F.when(long & (F.size(names) > 2), F.substring_index(host, ".", -3)).otherwise(pair), suffix


def _strength(children: DataFrame) -> float:
    """Prior strength of a level from (n, bad, prior mean) of its children; one row reaches the driver."""
    p = F.col("prior")
    noise = F.col("n") * p * (1 - p)
    got = children.select(
        F.sum((F.col("bad") - F.col("n") * p) ** 2 - noise).alias("over"), F.sum(noise * (F.col("n") - 1)).alias("most")
    ).first()
    rho = got.over / got.most if got.most else 0.0
    return 1 / min(max(rho, 1e-3), 0.9) - 1


def reputation(pages: DataFrame, labels: DataFrame, two_name_suffixes: Sequence[str] = ()) -> DataFrame:
    """``host``, ``n``, ``bad``, ``mean`` and ``lower`` for every host of ``pages``."""
    outcome = labels.select(F.col("doc_id").cast("long").alias("page_id"), ((F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("_bad"))
    outcome = outcome.filter("page_id is not null and _bad is not null").groupBy("page_id").agg(F.max(F.col("_bad").cast("int")).alias("_bad"))
    host, _ = host_and_path(F.col("url"))
    seen = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host")).join(outcome, "page_id", "left")
    domain, suffix = registered_domain(F.col("host"), two_name_suffixes)
    hosts = keep(
        seen.groupBy("host").agg(F.count("_bad").alias("n"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad")).withColumns({"domain": domain, "suffix": suffix}),
        "hosts",
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    rate = (total.bad + 0.5) / (total.n + 1) if total.n else 0.0  # without any outcome no host is suspected
    mean, parent = F.lit(rate), None
    above: DataFrame | None = None
    for level in ("suffix", "domain", "host"):
        kids = hosts if level == "host" else hosts.groupBy(level, *(["suffix"] if level == "domain" else [])).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        kids = kids.withColumn("prior", mean) if above is None else kids.join(above, parent, "left")
        s = F.lit(_strength(kids))
        above = kids.select(*[c for c in (level, "n", "bad") if level == "host" or c == level], ((F.col("bad") + s * F.col("prior")) / (F.col("n") + s)).alias("prior"), *([(F.col("n") + s).alias("_size")] if level == "host" else []))
        parent = level
    spread = F.sqrt(F.col("prior") * (1 - F.col("prior")) / (F.col("_size") + 1))
    return above.select("host", "n", "bad", F.col("prior").alias("mean"), (F.col("prior") - Z * spread).alias("lower"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES, limit: float = LIMIT) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``mean``, ``lower`` for every page."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    action, rule = matching_rule(F.col("host"), F.col("path"), rules)
    judged = rows.join(reputation(pages, labels).select("host", "mean", "lower"), "host", "left")
    by_host = F.when(F.col("lower") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, by_host).alias("verdict"), "mean", "lower")


SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), o AS (
  SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR coalesce(toxic, 0) = 1) GROUP BY doc_id
), h AS (
  SELECT host, CAST(count(o.bad) AS DOUBLE) AS n, CAST(coalesce(sum(o.bad), 0) AS DOUBLE) AS bad,
    regexp_extract(host, '([^.]*[.])?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix
  FROM p LEFT JOIN o USING (page_id) GROUP BY host
), s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT CASE WHEN sum(n) = 0 THEN 0 ELSE (sum(bad) + 0.5) / (sum(n) + 1) END FROM h) AS prior FROM h GROUP BY suffix),
ss AS (SELECT 1 / least(greatest(coalesce(sum((bad - n * prior) ^ 2 - n * prior * (1 - prior)) / nullif(sum(n * prior * (1 - prior) * (n - 1)), 0), 0), 1e-3), 0.9) - 1 AS s FROM s),
d AS (SELECT h.domain, h.suffix, sum(h.n) AS n, sum(h.bad) AS bad, any_value((s.bad + ss.s * s.prior) / (s.n + ss.s)) AS prior FROM h JOIN s USING (suffix), ss GROUP BY h.domain, h.suffix),
ds AS (SELECT 1 / least(greatest(coalesce(sum((bad - n * prior) ^ 2 - n * prior * (1 - prior)) / nullif(sum(n * prior * (1 - prior) * (n - 1)), 0), 0), 1e-3), 0.9) - 1 AS s FROM d),
k AS (SELECT h.host, h.n, h.bad, (d.bad + ds.s * d.prior) / (d.n + ds.s) AS prior FROM h JOIN d USING (domain), ds),
ks AS (SELECT 1 / least(greatest(coalesce(sum((bad - n * prior) ^ 2 - n * prior * (1 - prior)) / nullif(sum(n * prior * (1 - prior) * (n - 1)), 0), 0), 1e-3), 0.9) - 1 AS s FROM k),
m AS (SELECT host, n + ks.s AS size, (bad + ks.s * prior) / (n + ks.s) AS mean FROM k, ks),
r AS (SELECT p.*, m.mean - 1.645 * sqrt(m.mean * (1 - m.mean) / (m.size + 1)) AS lower,
  CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p JOIN m USING (host))
SELECT page_id, host, path, rule, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow'
  WHEN 'org/fr/' THEN 'allow' ELSE CASE WHEN lower > 0.3 THEN 'block' ELSE 'allow' END END AS verdict FROM r
"""
