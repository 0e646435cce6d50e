"""Operator 4: rules for urls, by a sorted sweep over reversed-host keys.

A rule is a host and the beginning of a path; it fits the host and its subdomains. A url is looked up
under its host and every parent host, each written from the top domain down and followed by the path.
Under such a key the urls of a rule are one interval, which begins at the rule, and intervals of one
host are nested or apart. Rules and urls are sorted together; each rule carries the stack of rules it
lies in, and a url reads the stack of the last rule before it. The rules of that stack that the url
begins with are all the rules that fit.

Urls of a host that has more than a thousandth of all are dealt to ``salts`` sweeps by a hash of their rows, and the
rules of that host to each of them, so that no host is swept by one task alone. There are at most a thousand such
hosts; the rules of all others are there once.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wickframe.llm.runtime import written

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

SALTS = 64
# A host with more than this part of the urls is hot.
HOT_HOSTS = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]] = RULES) -> DataFrame:
    """``(verdict, rule)`` pairs, a rule being host and path as in ``example.org/es/``."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def _down(host: Column) -> Column:
    """Labels from the top domain down, joined."""
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _stacked(rules: DataFrame) -> DataFrame:
    """``(top, path, stack)``: each rule with the rules of its host that its path begins with, itself included.

    Of rules with one host and path the verdict last in the alphabet counts, so block wins over allow.
    """
    cut = F.expr("locate('/', rule)")
    split = rules.where("rule is not null and verdict is not null and rule <> ''").select(
        F.translate(F.when(cut > 0, F.expr("substring(rule, 1, locate('/', rule) - 1)")).otherwise(F.col("rule")), _UPPER, _LOWER).alias("host"),
        F.when(cut > 0, F.expr("substring(rule, locate('/', rule))")).otherwise("").alias("path"),
        "verdict",
    )
    once = split.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    named = once.select(_down(F.col("host")).alias("top"), "path", "verdict", F.concat("host", "path").alias("rule"))
    parts = named.select("top", "path", F.explode(F.sequence(F.lit(0), F.length("path"))).alias("size")).select(
        "top", "path", F.expr("left(path, size)").alias("part")
    )
    outer = named.select("top", F.col("path").alias("part"), "rule", "verdict")
    entry = F.struct(F.length("part").alias("size"), F.col("part").alias("path"), "rule", "verdict")
    return parts.join(outer, ["top", "part"]).groupBy("top", "path").agg(F.sort_array(F.collect_list(entry)).alias("stack"))


def _hot(tops: DataFrame) -> DataFrame:
    """``(top, hot)`` of the hosts, or parts of hosts, that hold more than a ``HOT_HOSTS``-th of the urls."""
    counts = written(tops.groupBy("top").agg(F.count("*").alias("urls")), "hosts")
    whole = counts.agg(F.sum("urls")).first()[0] or 0
    return counts.where(F.col("urls") * HOT_HOSTS > whole).select("top", F.lit(True).alias("hot"))


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    salts: int = SALTS,
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` for each row of ``pages``; the longest rule that fits decides.

    Where none fits, ``rule`` is null and a url with a host is allowed, one without (null, or no ``://``)
    is blocked. Rows that are wholly equal are judged once and come back as often as they were. Null ids
    are ids like others; columns beside id and url are ignored.
    """
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    rows = (
        urls.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .groupBy("id", "host", "path")
        .agg(F.count("*").alias("copies"))
    )
    labels = F.split("host", r"\.")
    suffixes = F.when(
        F.col("host") != "",
        F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda n: F.array_join(F.slice(F.reverse(labels), 1, n), "."),
        ),
    )
    hosts = urls.select(host_of(F.col("url")).alias("host"))
    hot = F.broadcast(_hot(hosts.select(F.explode(suffixes).alias("top"))))
    placed = rows.select("*", F.explode_outer(suffixes).alias("top")).join(hot, "top", "left")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "host", "path"), F.lit(salts))).otherwise(F.lit(0).cast("bigint"))
    wanted = placed.select(
        "top",
        salt.alias("salt"),
        F.col("path").alias("key"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("array<struct<size: int, path: string, rule: string, verdict: string>>").alias("stack"),
        F.struct("id", "host", "path", "copies").alias("row"),
    )
    last = F.when(F.col("hot"), F.lit(salts - 1)).otherwise(0).cast("bigint")
    known = _stacked(rules).join(hot, "top", "left").select(
        "top",
        F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("salt"),
        F.col("path").alias("key"),
        F.lit(0).alias("kind"),
        "stack",
        F.lit(None).cast(wanted.schema["row"].dataType).alias("row"),
    )
    sweep = (
        Window.partitionBy("top", "salt")
        .orderBy("key", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = wanted.unionByName(known).withColumn("active", F.last("stack", ignorenulls=True).over(sweep))
    fitting = F.filter("active", lambda rule: F.startswith(F.col("key"), rule["path"]))
    found = swept.where("kind = 1").select("row.*", F.get(fitting, F.size(fitting) - 1).alias("rule"))
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule.rule").alias("size"), "rule.rule", "rule.verdict")))
    judged = found.groupBy("id", "host", "path", "copies").agg(best.alias("best"))
    otherwise = F.when(F.col("host") != "", "allow").otherwise("block")
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", otherwise).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


_LISTED = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in RULES)
SQL = f"""
with rules as (
  select verdict, rule, split_part(rule, '/', 1) as rule_host, substr(rule, strpos(rule, '/')) as rule_path
  from (values {_LISTED}) as listed(verdict, rule)
),
urls as (
  select row_number() over () as row_id, page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages
),
fitting as (
  select row_id, rule, verdict, row_number() over (partition by row_id order by length(rule) desc, rule desc) as place
  from urls join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule,
  coalesce(verdict, case when host <> '' then 'allow' else 'block' end) as verdict
from urls left join (select * from fitting where place = 1) using (row_id)
"""
