"""Connected components and skewed joins in tables; no link or component passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickframe.llm.runtime import written

# Keys that hold more than this part of the rows are joined by broadcast: there are at most that many.
HOT_KEYS = 1000
# Where facts are too large for that: rows that a task can take of one key, and tasks that share more.
CROWD = 2000
SALTS = 32


def contracted(components: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, component)`` after the links have joined components; names are their smallest nodes."""
    joined = links
    while True:
        of_a = components.select(F.col("node").alias("a"), F.col("component").alias("c_a"))
        of_b = components.select(F.col("node").alias("b"), F.col("component").alias("c_b"))
        apart = (
            salted_join(salted_join(joined, of_a, "a", "b"), of_b, "b", "a", joined)
            .where("c_a <> c_b")
            .select(F.greatest("c_a", "c_b").alias("a"), F.least("c_a", "c_b").alias("b"))
            .distinct()
        )
        apart = written(apart, "links")
        if apart.isEmpty():
            return components
        parents = written(apart.groupBy("a").agg(F.min("b").alias("b")), "parents")
        while True:  # follow pointers; they fall, so they end
            above = parents.select(F.col("a").alias("b"), F.col("b").alias("c"))
            stepped = parents.join(above, "b", "left")
            moved = written(stepped.select("a", F.coalesce("c", "b").alias("b"), F.col("c").isNotNull().alias("moved")), "parents")
            parents = moved.select("a", "b")
            if moved.where("moved").isEmpty():
                break
        ends = parents.select(F.col("a").alias("component"), F.col("b").alias("end"))
        components = written(
            components.join(ends, "component", "left").select("node", F.coalesce("end", "component").alias("component")),
            "components",
        )
        joined = apart  # names of components are nodes too


def salted_join(rows: DataFrame, facts: DataFrame, key: str, spread: str, counted: DataFrame | None = None) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row for each key, by a shuffle without hot keys.

    A key that holds more than a thousandth of the rows, and more than ``CROWD``, is dealt over ``SALTS`` tasks
    by the column ``spread``; its facts, however large, go to each of them. There are at most ``HOT_KEYS`` such keys.
    Keys are counted in ``counted``, a table that has those of ``rows``, which is one itself unless that is given.
    """
    counted = rows if counted is None else counted
    counts = counted.groupBy(key).agg(F.count("*").alias("held")).where(f"held > {CROWD}")
    counts = written(counts, "hot-keys")
    if counts.isEmpty():
        return rows.join(facts, key)
    whole = counted.count()
    hot = F.broadcast(counts.where(F.col("held") * HOT_KEYS > whole).select(key, F.lit(True).alias("hot")))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.join(hot, key, "left").withColumn("salt", salt).drop("hot")
    copies = facts.join(hot, key, "left").withColumn("salt", F.explode(salts)).drop("hot")
    return dealt.join(copies, [key, "salt"]).drop("salt")


def joined_with_hot_keys(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``facts``, one row for each key, wherever one key holds many of the rows.

    At most ``HOT_KEYS`` keys can hold more than a thousandth of the rows each. Their facts are broadcast, so
    their rows stay where they are; all others are joined by a shuffle, in which no key is large.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("held"))
    whole = counts.agg(F.sum("held")).first()[0] or 0
    hot = written(facts.join(counts.where(F.col("held") * HOT_KEYS > whole).select(key), key, "left_semi"), "hot-keys")
    marked = rows.join(F.broadcast(hot), key, "left_anti")
    return marked.join(facts, key).unionByName(rows.join(F.broadcast(hot), key))
