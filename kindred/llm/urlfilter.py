"""URL filters: rules on hosts and paths, and empirical-Bayes reputation of hosts.

Labelled page outcomes are counted for each host, registered domain and suffix.
Each level's bad rate is shrunk towards its parent's through a beta-binomial
prior: the corpus rate is the prior of the suffixes, a suffix's posterior mean
that of its domains, a domain's that of its hosts.  The prior's strength is
fitted for each level by moments over that level's units.  A url is blocked
where the lower bound of its host's posterior bad rate exceeds `max_bad`.
Hosts without labels get their domain's or suffix's posterior.

Defined results.  A null url, or one without `://`, has an empty host and path
and gets the corpus prior.  Labels that are null do not count as outcomes;
several labels of one page all count.  Rows that repeat a page_id are judged
each on its own url, and a label counts for each of them.  Urls of any length
are read whole.  Ties between rules go to the longest, and no two are equal.
Further columns of pages, whatever their names, pass through `filter_pages`
untouched.  With no labels at all nothing is blocked by the method.  An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import materialize, sized_join

#: (action, rule): the host part up to the first "/", the path from there on.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Two-label public suffixes, known ones of the largest registries (fixed values).
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its action; nulls where none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def name_of(host: Column) -> Column:
    """The host's name without user information, port and the dot at its end: what suffixes and domains are cut from."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"\.?(:[0-9]*)?$", "")


def suffix_of(host: Column) -> Column:
    host = name_of(host)
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    host = name_of(host)
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) for each labelled page; a label belongs to the page whose page_id is its doc_id.

    Bad is a toxic or a low-quality label.
    """
    bad = F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)
    marked = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")).where("bad IS NOT NULL")
    return pages.select("page_id", host_of(F.col("url")).alias("host")).join(marked, "page_id").select("host", "bad")


def _level(units: DataFrame, least: float, most: float) -> float:
    """Strength of the beta prior over units (n, y, prior mean m), by the method of moments.

    With squared errors s2 = sum(n (y/n - m)^2) weighted by n: the spread of the rates
    beyond binomial noise fixes the intraclass correlation r, and the strength is 1/r - 1.
    """
    v = "m * (1 - m)"
    row = units.where("n > 0").selectExpr(f"sum(n * (y / n - m) * (y / n - m)) AS s", f"sum({v}) AS a", f"sum((n - 1) * {v}) AS b").head()
    if row.s is None or not row.b:
        return most
    r = (row.s - row.a) / row.b
    return most if r <= 1 / (most + 1) else max(least, 1 / r - 1)


def reputation(labelled: DataFrame, z: float = 1.645, least: float = 1.0, most: float = 10_000.0) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """Posterior tables of suffixes, domains and hosts: key, mean, lower; and the corpus prior.

    The lower bound is the mean less z posterior standard deviations.
    """
    hosts = materialize(labelled.groupBy("host").agg(F.count("*").cast("double").alias("n"), F.sum("bad").cast("double").alias("y"))
                        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "host-outcomes")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).head()
    n, y = total.n or 0.0, total.y or 0.0
    prior = (y + 0.5) / (n + 1.0)

    def posterior(units: DataFrame, key: str) -> DataFrame:
        k = _level(units, least, most)
        a, b = F.col("m") * k + F.col("y"), (1 - F.col("m")) * k + F.col("n") - F.col("y")
        sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
        out = units.select(*[c for c in units.columns if c not in ("n", "y", "m")], (a / (a + b)).alias("mean"), (a / (a + b) - z * sd).alias("lower"))
        return materialize(out, f"reputation-{key}")

    sums = [F.sum("n").alias("n"), F.sum("y").alias("y")]
    suffixes = posterior(hosts.groupBy("suffix").agg(*sums).withColumn("m", F.lit(prior)), "suffix")
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    domains = posterior(sized_join(domains, suffixes.select("suffix", F.col("mean").alias("m")), "suffix", "inner"), "domain")
    named = posterior(sized_join(hosts, domains.select("domain", F.col("mean").alias("m")), "domain", "inner").select("host", "n", "y", "m"), "host")
    return suffixes, domains, named, {"prior": prior, "n": n}


def annotate(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad: float = 0.5, z: float = 1.645) -> DataFrame:
    """Rows of pages as struct `_row`, with host, path, rule, verdict, bad_mean and bad_lower."""
    suffixes, domains, hosts, corpus = reputation(outcomes(pages, labels), z)
    urls = pages.select(F.struct("*").alias("_row")).select("_row", host_of(F.col("_row.url")).alias("host"), path_of(F.col("_row.url")).alias("path"))
    rule, action = matched_rule(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "action": action, "domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    for name, table in (("host", hosts), ("domain", domains), ("suffix", suffixes)):
        urls = sized_join(urls, table.select(name, F.col("mean").alias(f"{name}_mean"), F.col("lower").alias(f"{name}_lower")), name, "left")
    mean = F.coalesce("host_mean", "domain_mean", "suffix_mean", F.lit(corpus["prior"]))
    lower = F.coalesce("host_lower", "domain_lower", "suffix_lower", F.lit(0.0))
    method = F.when(lower > max_bad, "block").otherwise("allow")
    return urls.select("_row", "host", "path", "rule", F.coalesce("action", method).alias("verdict"), F.round(mean, 6).alias("bad_mean"), F.round(lower, 6).alias("bad_lower"))


def judge(pages: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_mean, bad_lower for every row of pages."""
    return annotate(pages, labels, **how).select("_row.page_id", "host", "path", "rule", "verdict", "bad_mean", "bad_lower")


def filter_pages(pages: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of pages whose url is allowed, with pages' own columns."""
    return annotate(pages, labels, **how).where("verdict = 'allow'").select("_row.*")


def _oracle() -> str:
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)

    def posterior(name: str, key: str, units: str) -> str:
        """CTEs: the units with prior mean m, the level's strength k, the posterior."""
        return f"""
{name}_u AS ({units}),
{name}_k AS (SELECT CASE WHEN s IS NULL OR b IS NULL OR b = 0 THEN 10000.0 WHEN (s - a) / b <= 1 / 10001.0 THEN 10000.0 ELSE greatest(1.0, 1 / ((s - a) / b) - 1) END AS k
  FROM (SELECT sum(n * (y / n - m) * (y / n - m)) AS s, sum(m * (1 - m)) AS a, sum((n - 1) * m * (1 - m)) AS b FROM {name}_u WHERE n > 0)),
{name}_p AS (SELECT {key}, a / (a + b) AS mean, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS lower
  FROM (SELECT {key}, m * k + y AS a, (1 - m) * k + n - y AS b FROM {name}_u, {name}_k))"""

    arms = "".join(f" WHEN (host = '{n}' OR ends_with(host, '.{n}')) AND starts_with(path, '/{r}') THEN '{x}'" for _, x in sorted(RULES, key=lambda q: (-len(q[1]), q[1])) for n, _, r in [x.partition("/")])
    acts = "".join(f" WHEN '{x}' THEN '{a}'" for a, x in RULES)
    return f"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}'), '') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
v AS (SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), '\\.?(:[0-9]*)?$', ''), '.') AS p FROM u),
w AS (SELECT page_id, host, path, CASE{arms} END AS rule, CASE WHEN array_to_string(p[-2:], '.') IN ({two}) THEN array_to_string(p[-2:], '.') ELSE p[-1] END AS suffix,
  CASE WHEN array_to_string(p[-2:], '.') IN ({two}) THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain FROM v),
o AS (SELECT host, domain, suffix, CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END AS bad FROM w JOIN labels ON page_id = doc_id WHERE toxic IS NOT NULL OR quality IS NOT NULL),
h AS (SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS y FROM o GROUP BY ALL),
g AS (SELECT (coalesce(sum(y), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS prior FROM h),
{posterior("s", "suffix", "SELECT suffix, sum(n) AS n, sum(y) AS y, any_value(prior) AS m FROM h, g GROUP BY suffix")},
{posterior("d", "domain", "SELECT domain, sum(n) AS n, sum(y) AS y, any_value(mean) AS m FROM h JOIN s_p USING (suffix) GROUP BY domain")},
{posterior("t", "host", "SELECT host, n, y, mean AS m FROM h JOIN d_p USING (domain)")},
j AS (SELECT page_id, w.host, path, rule, coalesce(t_p.mean, d_p.mean, s_p.mean, prior) AS mean, coalesce(t_p.lower, d_p.lower, s_p.lower, 0.0) AS lower
  FROM w CROSS JOIN g LEFT JOIN t_p ON t_p.host = w.host LEFT JOIN d_p ON d_p.domain = w.domain LEFT JOIN s_p ON s_p.suffix = w.suffix)
SELECT page_id, host, path, rule, CASE rule{acts} ELSE CASE WHEN lower > 0.5 THEN 'block' ELSE 'allow' END END AS verdict, round(mean, 6) AS bad_mean, round(lower, 6) AS bad_lower FROM j
"""


ORACLE_SQL = _oracle()
