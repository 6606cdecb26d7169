"""URL filters: written rules first, empirical-Bayes host reputation for every other URL.

Labelled page outcomes are counted by host, registered domain and suffix.  Each level's share of
good pages is shrunk towards its parent's through a beta-binomial prior, whose strength is
estimated from the spread of that level by the method of moments.  A URL passes if a lower bound of
its host's posterior reaches a threshold.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import lower_ascii, small_side, written

#: A host passes if its posterior mean less Z standard deviations is at least this.
LEAST_GOOD = 0.6
Z = 1.645
#: Suffixes of two labels; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")


@dataclass(frozen=True)
class Rule:
    """``host/path`` with a verdict, for the host and all its subdomains and for paths that start so."""

    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def rule_case(rules: tuple[Rule, ...], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, null if none does."""
    case = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(str(r))):
        case = F.when(_fits(rule, host, path), value(rule)).otherwise(case)
    return case


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(children: DataFrame) -> float:
    """The prior's weight in pages, from children with (n, good, parent mean ``m``)."""
    m, n = F.col("m"), F.col("n")
    row = children.agg(
        F.sum(F.pow(F.col("good") - n * m, F.lit(2.0))).alias("spread"),
        F.sum(n * m * (1 - m)).alias("binomial"),
        F.sum(n * (n - 1) * m * (1 - m)).alias("pairs"),
    ).first()
    if not row["pairs"]:
        return 1.0
    rho = (row["spread"] - row["binomial"]) / row["pairs"]
    return 1.0 / min(max(rho, 0.001), 0.99) - 1.0


def _shrunk(counts: DataFrame, level: str, parents: DataFrame | float, *parent: str) -> tuple[DataFrame, float]:
    """Posterior means of a level, given its parents' as (parent, m), or one mean for all."""
    summed = counts.groupBy(level, *parent).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    known = summed.join(parents, parent[0]) if parent else summed.withColumn("m", F.lit(parents))
    joined = written(known, f"reputation-{level}")
    k = _strength(joined)
    mean = (F.col("good") + k * F.col("m")) / (F.col("n") + k)
    return joined.select(level, "n", "good", F.col("m").alias("parent_m"), mean.alias("m")), k


def reputations(hosts: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """(host, good_bound) for every host, with lower bounds of the posterior share of good pages.

    ``hosts`` has one row per host; ``outcomes`` has (host, good 0 or 1), one row per labelled page.
    A host without labels has its registered domain's prior.
    """
    told = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.sum("good").alias("good"))
    counts = written(
        hosts.join(told, "host", "left").select(
            "host",
            domain_of(F.col("host")).alias("domain"),
            suffix_of(F.col("host")).alias("suffix"),
            F.coalesce("n", F.lit(0)).cast("double").alias("n"),
            F.coalesce("good", F.lit(0)).cast("double").alias("good"),
        ),
        "reputation-hosts",
    )
    row = counts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = ((row["good"] or 0.0) + 1.0) / ((row["n"] or 0.0) + 2.0)
    suffixes, _ = _shrunk(counts, "suffix", overall)
    domains, _ = _shrunk(counts, "domain", suffixes.select("suffix", "m"), "suffix")
    final, k = _shrunk(counts, "host", domains.select("domain", "m"), "domain")
    mean, weight = F.col("m"), F.col("n") + k
    bound = mean - z * F.sqrt(mean * (1 - mean) / (weight + 1))
    return final.select("host", F.round(bound, 9).alias("good_bound"))


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, least: float = LEAST_GOOD
) -> DataFrame:
    """Host, path, rule, ``good_bound`` and verdict of every page.

    ``pages`` has (page_id, url); ``outcomes`` has (url, good), rows with a null ``good`` are left
    out.  A null URL or one without ``://`` has an empty host and path and is judged like any
    other; equal rows are all returned; other columns are left out; no labels at all give every
    host the prior one half.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    told = outcomes.filter(F.col("good").isNotNull()).select(host_of(F.col("url")).alias("host"), "good")
    bounds = reputations(parsed.select("host").distinct(), told)
    host, path = F.col("host"), F.col("path")
    ruled = parsed.withColumn("rule", rule_case(rules, host, path, str)).withColumn(
        "ruled", rule_case(rules, host, path, lambda r: r.verdict)
    )
    bounds = small_side(written(bounds, "reputation-bounds"), 160)
    by_method = F.when(F.col("good_bound") >= least, "allow").otherwise("block")
    return ruled.join(bounds, "host").select(
        "page_id", "host", "path", "rule", "good_bound", F.coalesce("ruled", by_method).alias("verdict")
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, good): a page's number in its path names the labelled document that it shows."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})", 1)
    numbered = pages.select("url", F.when(number != "", number.cast("bigint")).alias("shown"))
    good = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0)
    return numbered.join(labels.select(F.col("doc_id").alias("shown"), good.alias("good")), "shown").select("url", "good")


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_urls(pages, page_outcomes(pages, labels)).withColumn("good_bound", F.round("good_bound", 6))


def _oracle() -> str:
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def level(name: str, parent: str, above: str, source: str) -> str:
        return f"""
{name}_sums as (
  select c.{name}, c.{parent}, sum(c.n) as n, sum(c.good) as good, any_value(p.m) as pm
  from {source} c join {above} p on c.{parent} = p.{parent} group by 1, 2),
{name}_k as (
  select case when coalesce(sum(n * (n - 1) * pm * (1 - pm)), 0) = 0 then 1.0 else
    1.0 / least(greatest((sum((good - n * pm) * (good - n * pm)) - sum(n * pm * (1 - pm)))
      / sum(n * (n - 1) * pm * (1 - pm)), 0.001), 0.99) - 1.0 end as k
  from {name}_sums),
{name}s as (select {name}, n, good, k, (good + k * pm) / (n + k) as m from {name}_sums, {name}_k)"""

    return f"""
with rules(rule_host, rule_path, verdict) as (values {rules}),
split as (
  select page_id, url, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
parsed as (
  select page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), '{upper}', '{upper.lower()}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from split),
told as (
  select host, count(*) as n, sum(case when quality = 1 and toxic = 0 then 1 else 0 end) as good
  from parsed p join labels l on try_cast(regexp_extract(path, '/([0-9]{{1,18}})', 1) as bigint) = l.doc_id
  group by 1),
parts as (select distinct host, string_split(host, '.') as a from parsed),
counts as (
  select h.host, '' as root,
    case when array_to_string(a[-2:], '.') in ({two}) then array_to_string(a[-3:], '.')
      else array_to_string(a[-2:], '.') end as domain,
    case when array_to_string(a[-2:], '.') in ({two}) then array_to_string(a[-2:], '.') else a[-1] end as suffix,
    cast(coalesce(n, 0) as double) as n, cast(coalesce(good, 0) as double) as good
  from parts h left join told t on h.host = t.host),
roots as (select '' as root, (coalesce(sum(good), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) as m from counts),
{level("suffix", "root", "roots", "counts").strip()},
{level("domain", "suffix", "suffixs", "counts").strip()},
{level("host", "domain", "domains", "counts").strip()},
bounds as (select host, round(m - {Z} * sqrt(m * (1 - m) / (n + k + 1)), 9) as good_bound from hosts),
ruled as (
  select p.page_id, p.host, p.path, r.rule_host || r.rule_path as rule, r.verdict,
    row_number() over (partition by p.page_id, p.url order by length(r.rule_host || r.rule_path) desc nulls last) as i
  from parsed p left join rules r
    on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path))
select r.page_id, r.host, r.path, r.rule, round(b.good_bound, 6) as good_bound,
  coalesce(r.verdict, case when b.good_bound >= {LEAST_GOOD} then 'allow' else 'block' end) as verdict
from ruled r join bounds b on r.host = b.host where i = 1
"""


ORACLE = _oracle()
