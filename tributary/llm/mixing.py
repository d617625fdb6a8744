"""Mixing to target weights by hierarchical budgets.

A token budget runs down a tree (say domain, language, source). Each node's
children share its budget by weight; what a child cannot take, its tokens times
the epochs allowed, goes to its brothers first, and only what the whole subtree
cannot take has gone to the node's own brothers. Every leaf then takes whole
epochs and a token-prefix of the next one, in an order seeded for that epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..literals import literal_table
from .storage import stored

SLICE_DIGITS = 3  # hex digits of the order key by which a leaf's prefix sum is cut: 4096 slices
WORD = r"[^\x20\x09-\x0D]+"


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``budget`` to ``children(parent..., name, capacity, weight, given)``.

    Water-filling: in the order of capacity per weight, the level at which the
    rest of the budget would be even is highest at the first child that is not
    filled up, and all take up to that level.
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("capacity") / F.col("weight"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    level = left.cast("double") / F.sum("weight").over(after)
    return (
        children.where("weight > 0")
        .withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(group))
        .withColumn(
            "budget",
            F.least("capacity", F.greatest(F.floor(F.col("_level") * F.col("weight")), F.lit(0))),
        )
        .drop("_level", "given")
    )


def leaf_budgets(
    leaves: DataFrame, levels: list[str], weights: dict[tuple, int], budget_share: float, epochs: int
) -> DataFrame:
    """``leaves(levels..., tokens)`` with ``budget``: tokens to take from each.

    ``weights`` names nodes by their path; others weigh 1, and 0 leaves a node out.
    """
    spark = leaves.sparkSession
    sized = leaves.withColumn("capacity", F.col("tokens") * epochs)
    given = sized.agg(
        F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(budget_share)).alias("given")
    )
    for depth in range(1, len(levels) + 1):
        path, parent = levels[:depth], levels[: depth - 1]
        known = [(*k, w) for k, w in weights.items() if len(k) == depth]
        children = sized.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        if known:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in path])
            table = literal_table(spark, known, schema.add("weight", T.LongType()))
            children = children.join(F.broadcast(table), path, "left")
        else:
            children = children.withColumn("weight", F.lit(None).cast("bigint"))
        children = children.withColumn("weight", F.coalesce("weight", F.lit(1)))
        if parent:
            children = children.join(given, parent)
        else:
            children = children.join(F.broadcast(given), F.lit(True))  # one row
        given = share_out(children, parent, path[-1]).select(
            *path, F.col("budget").alias("given")
        )
    return leaves.join(given.withColumnRenamed("given", "budget"), levels)


def choose(
    docs: DataFrame,
    levels: list[str],
    weights: dict[tuple, int],
    budget_share: float,
    epochs: int,
    seed: int,
) -> DataFrame:
    """``(doc_id, text_hash, levels..., n_tokens, copies)`` of the documents taken.

    Tokens are words between white space. Rows that repeat a doc_id and a text
    count as one document; a null or empty text has no tokens and goes with any
    whole epoch, and with a prefix while it is not full. Null levels count as ''.
    """
    cleaned = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels]
    counted = stored(
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            *cleaned,
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_tokens"),
        ).dropDuplicates(["doc_id", "text_hash"]),
        "mix-tokens",
    )
    leaves = counted.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    plan = stored(
        leaf_budgets(leaves, levels, weights, budget_share, epochs).select(
            *levels,
            F.expr("budget div tokens").alias("whole"),
            (F.col("budget") % F.col("tokens")).alias("rest"),
        ),
        "mix-plan",
    )
    text_key = F.concat_ws(":", F.lit(str(seed)), F.col("whole") + 1, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = stored(
        counted.join(plan, levels)
        .withColumn("key", F.md5(text_key))
        .withColumn("slice", F.substring("key", 1, SLICE_DIGITS)),
        "mix-keyed",
    )
    group = [*levels, "slice"]
    along = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        keyed.groupBy(*group)
        .agg(F.sum("n_tokens").alias("inside"))
        .withColumn("before", F.coalesce(F.sum("inside").over(along), F.lit(0)))
    )
    placed = keyed.join(slices, group)
    whole = placed.where("before + inside <= rest").withColumn("part", F.lit(1))
    out = placed.where("before >= rest and before + inside > rest").withColumn("part", F.lit(0))
    row = Window.partitionBy(*group).orderBy("key", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    cut = (  # at most one slice a leaf
        placed.where("before < rest and before + inside > rest")
        .withColumn("part", (F.col("before") + F.sum("n_tokens").over(row) <= F.col("rest")).cast("int"))
    )
    columns = ["doc_id", "text_hash", *levels, "n_tokens", (F.col("whole") + F.col("part")).alias("copies")]
    return (
        whole.select(columns).unionByName(out.select(columns)).unionByName(cut.select(columns)).where("copies > 0")
    )


def mix(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents taken, each as often as it has copies; columns stay as they are."""
    h, n, k = (_free(docs, x) for x in ("_hash", "_copies", "_id"))
    taken = chosen.select(F.col("doc_id").alias(k), F.col("text_hash").alias(h + "_"), F.col("copies").alias(n))
    marked = docs.withColumn(h, F.xxhash64("text")).dropDuplicates(["doc_id", h])
    same = marked["doc_id"].eqNullSafe(taken[k]) & (marked[h] == taken[h + "_"])
    return (
        marked.join(taken, same)
        .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))))
        .select(*[marked[c] for c in docs.columns])
    )


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name
