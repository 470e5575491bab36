"""Near-duplicate prompts by the Jaccard likeness of their token sets, exact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import token_set
from ..scratch import kept


def jaccard_links(items: DataFrame, id_: str, text: str, least: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """(classes: id, rep) and (links: a, b between representatives, a < b).

    Items with one token set form a class. Sets are joined on their rarest tokens only: two sets of likeness t share
    one of the first n - ceil(t n) + 1 tokens in order of rarity, and sizes differ by at most the factor t.
    """
    sets = items.select(F.col(id_).alias("id"), F.array_sort(token_set(F.col(text))).alias("tokens")).where(F.size("tokens") > 0)
    reps = sets.groupBy("tokens").agg(F.min("id").alias("rep"))
    classes = sets.join(reps, "tokens").select("id", "rep")
    rank = reps.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    each = reps.select("rep", F.size("tokens").alias("n"), F.explode("tokens").alias("token")).join(rank, "token")
    ordered = each.groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("o"))
    prefix = ordered.select("rep", "n", F.explode(F.slice("o", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1).cast("int"))["token"]).alias("token"))
    a, b = prefix.alias("a"), prefix.alias("b")
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.rep") < F.col("b.rep")) & (F.col("a.n") >= least * F.col("b.n")) & (F.col("b.n") >= least * F.col("a.n")))
    pairs = met.select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()
    full = pairs.join(reps.select(F.col("rep").alias("a"), F.col("tokens").alias("x")), "a").join(reps.select(F.col("rep").alias("b"), F.col("tokens").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y"))
    return classes, full.where(both / (F.size("x") + F.size("y") - both) >= least).select("a", "b")


def near_duplicates(items: DataFrame, id_: str, text: str, least: float = 0.85) -> DataFrame:
    """Per item: its class and to how many other items it is linked."""
    classes, links = jaccard_links(items, id_, text, least)
    sizes = classes.groupBy("rep").agg(F.count("*").alias("size"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    far = both.join(sizes.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("size").alias("far"))
    near = classes.join(sizes, "rep").join(far.withColumnRenamed("a", "rep"), "rep", "left")
    out = items.select(F.col(id_).alias("id")).join(near, "id", "left")
    return out.select(F.col("id").alias(id_), F.coalesce("rep", "id").alias("class_id"), F.coalesce(F.col("size") - 1 + F.coalesce("far", F.lit(0)), F.lit(0)).cast("long").alias("n_links"))


def greedy_accept(items: DataFrame, id_: str, text: str, least: float = 0.85, keep=kept) -> DataFrame:
    """In order of id, each item that is like no accepted earlier one; solved in rounds over the links.

    An item with no open or accepted earlier neighbour is accepted; neighbours of accepted ones are refused.
    """
    classes, links = jaccard_links(items, id_, text, least)
    nodes = keep(classes.select("rep").distinct().withColumn("state", F.lit(0)))
    links = keep(links)
    while nodes.where("state = 0").limit(1).count():
        state = nodes.select(F.col("rep").alias("a"), F.col("state").alias("sa"))
        seen = links.join(state, "a").groupBy("b").agg(F.bool_or(F.col("sa") == 1).alias("hit"), F.bool_or(F.col("sa") == 0).alias("open"))
        now = nodes.join(seen.withColumnRenamed("b", "rep"), "rep", "left")
        nodes = keep(now.select("rep", F.when(F.col("state") != 0, F.col("state")).when(F.coalesce("hit", F.lit(False)), 2).when(F.coalesce("open", F.lit(False)), 0).otherwise(1).alias("state")))
    return items.join(nodes.where("state = 1").select(F.col("rep").alias(id_)), id_, "left_semi")
