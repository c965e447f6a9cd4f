"""URL filters: fixed rules first, empirical-Bayes host reputation for the rest
(native DataFrame code).

Labelled page outcomes are counted for each host.  Beta-binomial priors shrink
them level by level: all pages, suffix, registered domain, host.  How strongly
a level shrinks (its prior's weight in pages) is fitted by moments from the
spread of its members around their parent's rate.  A host is blocked when the
lower posterior bound of its share of bad pages passes a limit, so a host with
few labels is judged mostly by its domain and never on a few bad pages alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed by the query's contract.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

#: A host is blocked when mean - Z * standard deviation of its posterior passes LIMIT.
LIMIT, Z = 0.5, 1.645
#: Bounds of a fitted prior's weight, in pages.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), upper, upper.lower()),
            F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2))


def match_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.text).otherwise(text)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def document_number(path: Column) -> Column:
    """The document a page shows: the number that ends its path, or null."""
    return F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html?)?/?$", 1).try_cast("long")


def outcomes(labels: DataFrame) -> DataFrame:
    """(doc, bad): 1 if any label of the document says low quality or toxic.
    Rows without any label value or without doc_id don't count."""
    bad = F.greatest(F.col("toxic") == 1, F.col("quality") == 0)  # greatest skips nulls
    return labels.filter(F.col("doc_id").isNotNull() & bad.isNotNull()).groupBy(
        F.col("doc_id").alias("doc")).agg(F.max(bad.cast("int")).alias("bad"))


def _level(rows: DataFrame) -> DataFrame:
    """The beta prior of each member of a level: ``up`` (its mean) and ``weight``.

    ``rows``: n, bad, and the parent's p_n, p_bad, p_up, p_weight.  The prior's
    mean is the parent's posterior mean without the member's own pages; its
    weight is fitted by moments, and no more than is known about the parent
    without them.
    """
    raw = F.try_divide(F.col("p_bad"), F.col("p_n"))
    spread = rows.agg(
        F.sum("n").alias("pages"), F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.count(F.when(F.col("n") > 0, 1)).alias("members"),
        F.sum(F.try_divide(F.pow(F.col("bad") - F.col("n") * raw, 2), F.col("n") * raw * (1 - raw))).alias("q"))
    room = F.col("pages") - F.try_divide(F.col("squares"), F.col("pages"))
    share = F.try_divide(F.coalesce("q", F.lit(0.0)) - (F.col("members") - 1), room)
    weight = F.when((F.col("members") > 1) & (room > 0) & (share > 0),
                    F.least(F.greatest(F.try_divide(F.lit(1.0), share) - 1, F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT))
                    ).otherwise(F.lit(MOST_WEIGHT))
    known = F.col("p_weight") + F.col("p_n") - F.col("n")
    own = [c for c in rows.columns if not c.startswith("p_")]
    return rows.crossJoin(F.broadcast(spread.select(weight.alias("fitted")))).select(  # one row
        *own, ((F.col("p_up") * F.col("p_weight") + F.col("p_bad") - F.col("bad")) / known).alias("up"),
        F.least(F.col("fitted"), known).alias("weight"))


def _as_parent(level: DataFrame, key: str) -> DataFrame:
    return level.select(key, *[F.col(c).alias(f"p_{c}") for c in ("n", "bad", "up", "weight")])


def reputation(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """One row per host of ``pages``: host, domain, suffix, n, bad, mean, bound.

    ``mean`` and ``bound`` are the posterior mean and lower bound of the host's
    share of bad pages.  Without any label every host has mean 0.5 and a bound
    under the limit.
    """
    host, path = parts(F.col(url_col))
    seen = (pages.select(host.alias("host"), document_number(path).alias("doc"))
                 .groupBy("host", "doc").agg(F.count(F.lit(1)).alias("n")))  # a hot host or page is summed map-side
    told = seen.join(outcomes(labels), "doc", "left")
    labels_of = F.split(F.col("host"), r"\.")
    hosts = cut(told.groupBy("host").agg(
        F.sum(F.when(F.col("bad").isNotNull(), F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(0)).alias("bad"))
        .withColumn("suffix", F.element_at(labels_of, -1))
        .withColumn("domain", F.array_join(F.slice(labels_of, -F.least(F.lit(2), F.size(labels_of)), 2), ".")))

    def summed(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    top = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("p_n"),
                    F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("p_bad"),
                    F.lit(0.5).alias("p_up"), F.lit(2.0).alias("p_weight"))
    suffixes = cut(_level(summed(hosts, "suffix").crossJoin(F.broadcast(top))))  # one row
    domains = cut(_level(summed(hosts, "suffix", "domain").join(_as_parent(suffixes, "suffix"), "suffix")))
    level = _level(hosts.join(_as_parent(domains, "domain"), "domain"))
    a = F.col("up") * F.col("weight") + F.col("bad")
    b = (1 - F.col("up")) * F.col("weight") + F.col("n") - F.col("bad")
    return level.select("host", "domain", "suffix", "n", "bad", (a / (a + b)).alias("mean"),
                        (a / (a + b) - Z * F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[Rule] = RULES, limit: float = LIMIT) -> DataFrame:
    """One row per page: ``id_col``, host, path, rule, verdict, bad_mean, bad_bound.

    Null urls and urls without "://" have an empty host and path; they are
    judged like the pages of any other host.  Repeated rows are judged alike;
    null ids pass through.  Other columns are not read.
    """
    host, path = parts(F.col(url_col))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    known = cut(reputation(pages, labels, url_col).select("host", "mean", "bound"))
    own = F.when(F.col("bound") > limit, "block").otherwise("allow")
    # plain exchanges on both sides: AQE broadcasts a small host table and splits a hot host otherwise
    return pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).join(known, "host").select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        F.round("mean", 6).alias("bad_mean"), F.round("bound", 6).alias("bad_bound"))


def _level_sql(rows: str) -> str:
    """A level's priors in DuckDB."""
    return f"""select * exclude (p_n, p_bad, p_up, p_weight),
    (p_up * p_weight + p_bad - bad) / (p_weight + p_n - n) as up,
    least((select case when members > 1 and room > 0 and (q - (members - 1)) / room > 0
      then least(greatest(1 / ((q - (members - 1)) / room) - 1, {LEAST_WEIGHT}), {MOST_WEIGHT})
      else {MOST_WEIGHT} end
      from (select count(*) filter (n > 0) as members, sum(n) - sum(n * n) / sum(n) as room,
              coalesce(sum(case when n > 0 and p_n > 0 and p_bad > 0 and p_bad < p_n then
                (bad - n * (p_bad / p_n)) ** 2 / (n * (p_bad / p_n) * (1 - p_bad / p_n)) end), 0) as q from {rows})),
      p_weight + p_n - n) as weight from {rows}"""


def _sql() -> str:
    """The query in DuckDB."""
    order = sorted(RULES, key=lambda r: -len(r.text))
    fits = {r: f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')" for r in order}
    rule = " ".join(f"when {fits[r]} then '{r.text}'" for r in order)
    verdict = " ".join(f"when {fits[r]} then '{r.verdict}'" for r in order)
    return f"""
with u as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
p as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) as path from u),
l as (select doc_id, max(case when toxic = 1 or quality = 0 then 1 else 0 end) as bad from labels
      where doc_id is not null and (toxic is not null or quality is not null) group by doc_id),
h as (
  select host, count(l.bad)::double as n, coalesce(sum(l.bad), 0)::double as bad,
         list_extract(string_split(host, '.'), -1) as suffix,
         array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain
  from p left join l on l.doc_id = try_cast(regexp_extract(path, '/([0-9]{{1,18}})(?:\\.html?)?/?$', 1) as bigint)
  group by host),
s0 as (select suffix, sum(n) as n, sum(bad) as bad, (select sum(n) from h) as p_n, (select sum(bad) from h) as p_bad,
              0.5::double as p_up, 2::double as p_weight from h group by suffix),
s as ({_level_sql('s0')}),
d0 as (select h.suffix, h.domain, sum(h.n) as n, sum(h.bad) as bad, any_value(s.n) as p_n, any_value(s.bad) as p_bad,
              any_value(s.up) as p_up, any_value(s.weight) as p_weight
       from h join s using (suffix) group by h.suffix, h.domain),
d as ({_level_sql('d0')}),
h0 as (select h.host, h.n, h.bad, d.n as p_n, d.bad as p_bad, d.up as p_up, d.weight as p_weight
       from h join d using (domain)),
k as (select host, up * weight + bad as a, (1 - up) * weight + n - bad as b from ({_level_sql('h0')})),
r as (select host, a / (a + b) as mean, a / (a + b) - {Z} * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) as bound from k)
select page_id, host, path, case {rule} end as rule,
       case {verdict} when bound > {LIMIT} then 'block' else 'allow' end as verdict,
       round(mean, 6) as bad_mean, round(bound, 6) as bad_bound
from p join r using (host)
"""


SQL = _sql()
