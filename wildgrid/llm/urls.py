"""URL filters: explicit rules, and an empirical-Bayes reputation of hosts.

Reputation. Labelled page outcomes (good or not) are summed by host. A host's share
of good pages has a beta prior around its registered domain's mean, that one around
its suffix's, and that one around the mean of all; each level's prior strength is
estimated from the data (beta-binomial, method of moments over the groups of that
level). A host without labels has its domain's posterior, and so on upwards. A page
is allowed if the lower bound of its host's posterior reaches ``threshold``.

Only sums by host, by domain and by suffix are shuffled, with sums made before; a
host with a third of all pages is one row there. Hosts with more than one in
``HOT_PARTS`` of the pages, at most that many, are broadcast to the pages; pages of all
others meet their host's row in a shuffled join, which then has no large key.

The bound is the posterior's mean less ``Z`` deviations. Neither Spark nor SQL has the
inverse of the incomplete beta function, and by Cantelli's inequality no more than
1 / (1 + Z^2) of any posterior lies below such a bound; of nearly normal ones, with
``Z`` = 1, about a sixth does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, table, written

#: (verdict, host, path): a rule holds for its host and all hosts below, where the path begins with the rule's.
RULES = [
    ("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"), ("block", "org", "/es/"),
]
#: Second labels that make a suffix of two labels with a country's (a last label of two letters): co.uk, com.mx, or.at.
SECOND_LEVEL = ("ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "govt", "mil", "ne", "net", "nom", "or", "org", "sch")
#: Hosts with more than one in so many pages are broadcast: fewer than this many rows at any size.
HOT_PARTS = 1000
THRESHOLD = 0.35
_COUNTRY = rf"^({'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}\z"
#: IPv4 addresses in decimals, and IPv6 in brackets.
_ADDRESS = r"^([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|\[.*\])\z"
#: Standard deviations between the posterior's mean and its bound.
Z = 1.0
#: Strength of a prior whose groups don't differ more than chance, and the least one.
STRONGEST, WEAKEST = 1e4, 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path. Null, or no ``://``: both empty."""
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"^(?s:.*?)://((?s:.*))$", 1)).otherwise("")
    after = F.coalesce(after, F.lit(""))
    return lower_ascii(F.regexp_extract(after, r"^([^/?#]*)", 1)), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and all names above it, longest first: a.b.c, b.c, c."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def registered(host: Column, long_suffixes: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Registered domain and suffix, both without user and port; a name of one label and an address are both.

    Suffixes are the last label, or two by ``SECOND_LEVEL`` or among ``long_suffixes``
    (such as the public suffix list's entries of two labels).
    """
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*\\z", "")
    names = suffixes(name)
    n = F.size(names)
    two = F.element_at(names, -F.least(n, F.lit(2)))
    country = F.regexp_like(two, F.lit(_COUNTRY))
    long = country | two.isin(*long_suffixes) if long_suffixes else country
    address = F.regexp_like(name, F.lit(_ADDRESS))
    domain = F.when(address, name).when(long, F.element_at(names, -F.least(n, F.lit(3)))).otherwise(two)
    return domain, F.when(address, name).when(long, two).otherwise(F.element_at(names, -1))


def _strength(groups: DataFrame) -> float:
    """(s, n, mean_above) of a level's groups -> the strength of their prior, one number for the level.

    Method of moments for the beta-binomial around the parents' means: the variance of
    the groups' shares beyond that of coin flips.
    """
    labelled = F.col("n") > 0
    p = F.col("mean_above")
    spread = F.sum(F.when(labelled, F.pow(F.col("s") - F.col("n") * p, 2)))
    chance, room = F.sum(F.when(labelled, F.col("n") * p * (1 - p))), F.sum(F.when(labelled, F.col("n") * (F.col("n") - 1) * p * (1 - p)))
    # E[(s - n p)^2] = n p (1 - p) (1 + (n - 1) rho), k = 1 / rho - 1
    rho = F.try_divide(spread - chance, room)
    return groups.agg(F.coalesce(F.round(F.when(rho > 0, F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), 1 / rho - 1))), 6), F.lit(STRONGEST))).first()[0]


def host_reputation(outcomes: DataFrame, long_suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(host, good: 1, 0 or null) -> host, pages, s, n, a, b, mean, bound for every host among the rows.

    Null ``good`` rows aren't labelled but their hosts are scored. Without any label
    all means are 1/2. Empty hosts are hosts of their own. The sums of each level are
    written once; each level's prior strength is one number.
    """
    domain, suffix = registered(F.col("host"), long_suffixes)
    sums = F.sum("s").alias("s"), F.sum("n").alias("n")
    hosts = outcomes.groupBy("host").agg(F.count("*").alias("pages"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("s"), F.count("good").cast("double").alias("n"))
    hosts = written(hosts.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    domains = written(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    tops = domains.groupBy("suffix").agg(*sums)
    mean = tops.agg(F.coalesce(F.try_divide(F.sum("s"), F.sum("n")), F.lit(0.5))).first()[0]

    def posterior(level: DataFrame) -> DataFrame:
        k = F.lit(_strength(level))
        a = F.col("s") + k * F.col("mean_above")
        return level.withColumn("a", a).withColumn("b", F.col("n") + k - F.col("a")).withColumn("mean", F.col("a") / (F.col("n") + k))

    tops = posterior(tops.withColumn("mean_above", F.lit(mean)))
    domains = posterior(domains.join(tops.select("suffix", F.col("mean").alias("mean_above")), "suffix"))
    hosts = posterior(hosts.join(domains.select("domain", "suffix", F.col("mean").alias("mean_above")), ["domain", "suffix"]))
    size = F.col("a") + F.col("b")
    deviation = F.sqrt(F.greatest(F.lit(0.0), F.col("a") * F.col("b") / (size * size * (size + 1))))
    return hosts.select("host", "pages", "s", "n", "a", "b", F.col("mean"), F.greatest(F.lit(0.0), F.col("mean") - Z * deviation).alias("bound"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host) -> host, rules: the rules whose host is this one or above it."""
    names = hosts.select("host", F.explode(suffixes(F.col("host"))).alias("rule_host"))
    found = names.join(rules, names["rule_host"] == rules["rule_host_name"])
    each = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("size"), F.length("rule_host").alias("host_size"), F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_path").alias("path"), F.col("rule_verdict").alias("verdict"))
    return found.groupBy("host").agg(F.sort_array(F.collect_set(each), asc=False).alias("rules"))


def _with_host(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``pages`` with the column ``found`` of their host's row in ``hosts`` (host, pages, found).

    Pages of broadcast hosts have keys of their own in the shuffled join; should such a key be some
    host's name, what it finds isn't used.
    """
    total = F.broadcast(hosts.agg(F.sum("pages").alias("all_pages")))
    hot = hosts.join(total, F.col("pages") * HOT_PARTS > F.col("all_pages"), "left_semi")
    hot = hot.select(F.col("host").alias("hot_host"), F.col("found").alias("hot_found"))
    rest = hosts.select(F.col("host").alias("rest_host"), F.col("found").alias("rest_found"))
    paired = pages.join(F.broadcast(hot), F.col("host") == F.col("hot_host"), "left")
    key = F.when(F.col("hot_host").isNull(), F.col("host")).otherwise(F.concat(F.lit("/"), F.xxhash64("page_id", "path").cast("string")))
    paired = paired.join(rest, key == F.col("rest_host"), "left")
    return paired.withColumn("found", F.coalesce("hot_found", "rest_found")).drop("hot_host", "hot_found", "rest_host", "rest_found")


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] | None = None, threshold: float = THRESHOLD, url: str = "url", long_suffixes: tuple[str, ...] = ()) -> DataFrame:
    """``pages`` (page_id, url, others) with host, path, rule, verdict, reputation (the posterior's lower bound).

    ``outcomes``: (page_id, good), at most one row a page counts; repeated ones are
    merged by their smallest. The longest rule wins, then the one with the longer
    host, then the name; a page without one has the method's verdict. Null urls have
    empty hosts and are judged as such. Repeated pages stay. Columns named like those
    that are added are refused.
    """
    added = ["host", "path", "rule", "verdict", "reputation"]
    if clash := set(added) & {c.lower() for c in pages.columns}:
        raise ValueError(f"columns {sorted(clash)} clash with those that are added")
    spark = pages.sparkSession
    host, path = split_url(F.col(f"`{url}`"))
    narrow = pages.select("page_id", host.alias("host"))
    labels = outcomes.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(F.min("good").alias("good"))
    labelled = narrow.join(labels, "page_id", "left").select("host", "good")
    hosts = written(host_reputation(labelled, long_suffixes).select("host", "pages", F.col("bound").alias("reputation")), "reputation")
    if rules:
        listed = spark.createDataFrame([(h, p, v) for v, h, p in rules], "rule_host_name string, rule_path string, rule_verdict string")
        hosts = hosts.join(host_rules(hosts.select("host"), listed), "host", "left")
    else:
        hosts = hosts.withColumn("rules", F.lit(None).cast("array<struct<rule:string,path:string,verdict:string>>"))
    own = [F.col(f"`{c}`") for c in pages.columns]
    whole = pages.select("page_id", host.alias("host"), path.alias("path"), F.struct(*own).alias("row"))
    met = _with_host(whole, hosts.select("host", "pages", F.struct("reputation", "rules").alias("found")))
    fit = F.get(F.filter("found.rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    verdict = F.when(F.col("found.reputation") >= threshold, "allow").otherwise("block")
    return met.withColumn("fit", fit).select("row.*", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), verdict).alias("verdict"), F.col("found.reputation").alias("reputation"))


def op2_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document with its number: good if of quality and not toxic."""
    good = F.when(F.col("quality").isNotNull(), ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int"))
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), good.alias("good"))
    found = judge(table(spark, sf_dir, "pages").select("page_id", "url"), outcomes, RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", F.round("reputation", 6).alias("reputation"))


_LONG = f"regexp_matches(two, '{_COUNTRY}')"
_STRENGTH = f"coalesce(round(case when rho > 0 then greatest({WEAKEST}::double, least({STRONGEST}::double, 1 / rho - 1)) end, 6), {STRONGEST}::double)"
_RHO = """(sum(case when n > 0 then pow(s - n * m, 2) end) - sum(case when n > 0 then n * m * (1 - m) end))
  / nullif(sum(case when n > 0 then n * (n - 1) * m * (1 - m) end), 0)"""

OP2_SQL = f"""
with u as (
  select page_id, case when url is not null and instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as r from pages
), p as (
  select page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path from u
), l as (
  select doc_id, min(case when quality = 1 and coalesce(toxic, 0) = 0 then 1 when quality is null then null else 0 end) as good from labels where doc_id is not null group by doc_id
), h0 as (
  select host, coalesce(sum(good), 0)::double as s, count(good)::double as n from p left join l on page_id = doc_id group by host
), h1 as (
  select *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*\\z', '') as name from h0
), h2 as (
  select *, string_split(name, '.') as x, regexp_matches(name, '{_ADDRESS}') as address from h1
), h3 as (
  select *, len(x) as c, array_to_string(x[greatest(1, len(x) - 1):], '.') as two, array_to_string(x[greatest(1, len(x) - 2):], '.') as three from h2
), h as (
  select host, s, n, case when address then name when {_LONG} then three else two end as domain,
    case when address then name when {_LONG} then two else x[c] end as suffix from h3
), d as (select domain, suffix, sum(s) as s, sum(n) as n from h group by domain, suffix
), t as (select suffix, sum(s) as s, sum(n) as n from d group by suffix
), t1 as (select *, (select coalesce(sum(s) / nullif(sum(n), 0), 0.5::double) from t) as m from t
), tk as (select {_STRENGTH} as k from (select {_RHO} as rho from t1) q
), t2 as (select suffix, (s + k * m) / (n + k) as mean from t1, tk
), d1 as (select d.*, mean as m from d join t2 using (suffix)
), dk as (select {_STRENGTH} as k from (select {_RHO} as rho from d1) q
), d2 as (select domain, suffix, (s + k * m) / (n + k) as mean from d1, dk
), h4 as (select h.*, mean as m from h join d2 using (domain, suffix)
), hk as (select {_STRENGTH} as k from (select {_RHO} as rho from h4) q
), h5 as (select host, n + k as c, s + k * m as a from h4, hk
), h6 as (select host, greatest(0, a / c - {Z} * sqrt(greatest(0, a * (c - a) / (c * c * (c + 1))))) as bound from h5
), r(v, rh, rp) as (values {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}
), f as (
  select page_id, rh || rp as rule, v, row_number() over (partition by page_id order by length(rh || rp) desc, length(rh) desc, rh || rp desc) as k
  from p join r on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
)
select p.page_id, host, path, rule, coalesce(v, case when bound >= {THRESHOLD} then 'allow' else 'block' end) as verdict, round(bound, 6) as reputation
from p join h6 using (host) left join f on f.page_id = p.page_id and f.k = 1
"""
