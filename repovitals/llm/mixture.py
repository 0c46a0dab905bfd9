"""Mixing documents to target weights on a tree of domains, languages and sources.

The budget of tokens goes down the tree by weight. What a node cannot use its siblings take, in
proportion to their weights; only what all of them cannot use is missing from their parent, whose own
siblings then take it. Each leaf is filled from epochs over its documents, each epoch in an order of
its own drawn from the seed: whole epochs first, then the shortest prefix that reaches the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored, workspace

NONE = "(none)"
_BIG = "decimal(38,0)"
#: Hex digits of the order key that name a bucket; only one bucket of a leaf is put in order.
_BUCKET_DIGITS = 3


def _divide(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Add `got` to nodes (capacity, weight, and their parent's budget): whole tokens, none lost.

    In the order of capacity per weight the nodes that are filled come first. The others share what
    is left by weight, rounded so that the shares add up.
    """
    own = Window.partitionBy(*parents)
    order = own.orderBy(F.col("capacity") / F.col("weight"), "node")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    up_to = order.rowsBetween(Window.unboundedPreceding, 0)

    def total(column: str, window) -> Column:
        return F.coalesce(F.sum(F.col(column)).over(window), F.lit(0)).cast(_BIG)

    tested = nodes.withColumn(
        "full",
        F.col("capacity").cast(_BIG) * (total("weight", own) - total("weight", before))
        <= F.col("weight").cast(_BIG) * (F.col("budget").cast(_BIG) - total("capacity", before)),
    )
    shares = (
        tested.withColumn("taken", F.when(F.col("full"), F.col("capacity")).otherwise(0))
        .withColumn("open", F.when(F.col("full"), 0).otherwise(F.col("weight")))
        .withColumn("rest", (F.col("budget").cast(_BIG) - total("taken", own)).cast("long"))
        .withColumn("open_all", total("open", own).cast("long"))
        .withColumn("open_to", total("open", up_to).cast("long"))
    )
    share = F.expr(
        "(cast(rest as decimal(19,0)) * cast(open_to as decimal(19,0))) div open_all"
        " - (cast(rest as decimal(19,0)) * cast(open_to - weight as decimal(19,0))) div open_all"
    )
    return shares.withColumn("got", F.when(F.col("full"), F.col("capacity")).otherwise(share).cast("long")).drop(
        "full", "taken", "open", "rest", "open_all", "open_to"
    )


def leaf_budgets(leaves: DataFrame, levels: list[str], percent: int, max_epochs: int) -> DataFrame:
    """Add `budget` to leaves (one column per level, one w_<level> each, tokens).

    The whole budget is percent of all tokens, as far as max_epochs times the tokens of the nodes with
    a weight allow. A node whose weight, or that of a node above it, is NULL or not positive gets 0.
    """
    usable = F.lit(True)
    for level in levels:
        usable = usable & (F.coalesce(F.col(f"w_{level}"), F.lit(0)) > 0)
    capacity = F.when(usable, F.col("tokens") * max_epochs).otherwise(0)
    leaves = leaves.withColumn("capacity", capacity)
    whole = leaves.agg(
        F.least(F.expr(f"sum(tokens) * {percent} div 100"), F.sum("capacity")).cast("long").alias("budget")
    )
    given = whole.withColumn("root", F.lit(0))
    above = ["root"]
    open_leaves = leaves.where(usable).withColumn("root", F.lit(0))
    for level in levels:
        nodes = open_leaves.groupBy(*above, level).agg(
            F.sum("capacity").alias("capacity"), F.max(f"w_{level}").cast("long").alias("weight")
        )
        met = nodes.join(given, above).withColumn("node", F.col(level))
        given = _divide(met, above).select(*above, level, F.col("got").alias("budget"))
        above = [*above, level]
    return leaves.join(given.drop("root"), levels, "left").withColumn("budget", F.coalesce("budget", F.lit(0)))


def n_tokens(text: Column) -> Column:
    """Tokens of a text: its runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix_to_weights(
    documents: DataFrame,
    levels: dict[str, Column],
    weights: dict[str, Column],
    percent: int = 100,
    max_epochs: int = 1,
    seed: int = 42,
) -> DataFrame:
    """documents in the mixture of the given weights, one row per document and epoch.

    levels: the tree's levels from the top, by name, as expressions on documents; NULL is a node of
    its own, named '(none)'. weights: for each level an integer expression on the level's columns.
    percent, max_epochs: see leaf_budgets. Added (or replaced): the level columns as they are named,
    n_tokens, and epoch (from 0). The last epoch of a leaf ends with the document that reaches the
    budget. Rows of equal doc_id have one place in the order and stay or go together; texts without
    tokens cost nothing and go along. An empty table, or one without tokens, gives no rows.
    """
    spark = documents.sparkSession
    folder = workspace(spark)
    names = list(levels)
    added = {name.lower() for name in [*names, "n_tokens", "epoch"]}
    kept = [c for c in documents.columns if c.lower() not in added]
    placed = documents.select(
        *(F.col(f"`{c}`") for c in kept),
        *(F.coalesce(e.cast("string"), F.lit(NONE)).alias(name) for name, e in levels.items()),
        n_tokens(F.col("text")).alias("n_tokens"),
    )
    rows = stored(placed.select("doc_id", *names, "n_tokens"), f"{folder}/rows")
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    leaves = leaves.select("*", *(weights[name].cast("long").alias(f"w_{name}") for name in names))
    budgets = stored(
        leaf_budgets(leaves, names, percent, max_epochs)
        .where("budget > 0 and tokens > 0")
        .select(
            *names,
            F.expr("cast(budget div tokens as int)").alias("epochs"),
            (F.col("budget") % F.col("tokens")).alias("rest"),
        ),
        f"{folder}/budgets",
    )
    cuts = stored(_cuts(rows, budgets, names, seed), f"{folder}/cuts")
    epochs = F.expr("if(last_key is null, sequence(0, epochs - 1), sequence(0, epochs))")
    chosen = (
        placed.join(cuts, names)
        .where("epochs > 0 or last_key is not null")
        .withColumn("epoch", F.explode(epochs))
        .where((F.col("epoch") < F.col("epochs")) | (_order_key(seed, F.col("epoch"), F.col("doc_id")) <= F.col("last_key")))
    )
    return chosen.select(*(f"`{c}`" for c in kept), *names, "n_tokens", "epoch")


def _cuts(rows: DataFrame, budgets: DataFrame, names: list[str], seed: int) -> DataFrame:
    """Add to budgets last_key: up to which order key the last, partial epoch of each leaf goes.

    Tokens are summed by buckets of the key, and buckets of a leaf (at most 4,096) one after the
    other; only the bucket in which the rest is reached is looked at document by document.
    """
    keyed = (
        rows.join(budgets.where("rest > 0"), names)
        .withColumn("key", _order_key(seed, F.col("epochs"), F.col("doc_id")))
        .withColumn("bucket", F.substring("key", 1, _BUCKET_DIGITS))
    )
    buckets = keyed.groupBy(*names, "bucket").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    running = Window.partitionBy(*names).orderBy("bucket")
    reached = (
        buckets.withColumn("up_to", F.sum("tokens").over(running))
        .where("up_to >= rest and up_to - tokens < rest and tokens > 0")
        .select(*names, "bucket", (F.col("rest") - F.col("up_to") + F.col("tokens")).alias("missing"))
    )
    inside = keyed.join(reached, [*names, "bucket"]).groupBy(*names, "bucket", "key", "missing").agg(
        F.sum("n_tokens").alias("n")
    )
    order = Window.partitionBy(*names, "bucket").orderBy("key")
    last = (
        inside.withColumn("up_to", F.sum("n").over(order))
        .where("up_to >= missing and up_to - n < missing")
        .groupBy(*names)
        .agg(F.min("key").alias("last_key"))
    )
    return budgets.join(last, names, "left")
