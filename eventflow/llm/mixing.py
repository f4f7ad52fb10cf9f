"""Mixing sources to target weights with hierarchical token budgets."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.common import stored

LEVELS = ("domain", "lang", "source")
UNKNOWN = "unknown"
DIGITS = 3  # hexadecimal digits of the order by which tokens are first summed
Weights = dict[str, int]


def n_tokens(text: str | Column) -> Column:
    """Number of words: runs of anything but space and 0x09-0x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(column: str, weights: Weights | None) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(weights.items())])
    return F.coalesce(F.try_element_at(known, F.col(column)), F.lit(1)).cast("long")


def share_out(children: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Add ``given``: each child's part of its parent's ``budget``, by ``weight`` up to ``cap``.

    What a full child leaves goes to its siblings in proportion. A parent's budget is at
    most the sum of its children's caps, so only what no sibling can take went to the
    parent's own siblings before. Whole tokens, rounded down.
    """
    own = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = own.orderBy("fill", name)
    before = F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    # In order of cap / weight the full children come first.
    full = F.col("cap") * F.col("rest") <= (F.col("budget") - F.col("before")) * F.col("weight")
    return (
        children.withColumn("fill", F.col("cap") / F.greatest("weight", F.lit(1)))
        .withColumn("before", F.coalesce(before, F.lit(0))).withColumn("rest", rest)
        .withColumn("full", full)
        .withColumn("held", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(own))
        .withColumn("open", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(own))
        .withColumn(
            "given",
            F.when(F.col("full"), F.col("cap"))
            .otherwise(F.expr("((budget - held) * weight) div greatest(open, 1)")),
        )
        .drop("fill", "before", "rest", "full", "held", "open")
    )


def leaf_budgets(
    leaves: DataFrame, budget: int | None, max_epochs: int, weights: dict[str, Weights]
) -> DataFrame:
    """(domain, lang, source, tokens, given) from each leaf's tokens, top down."""
    dead = F.lit(False)
    for level in LEVELS:  # nothing can be taken below a weight of 0
        dead = dead | (_weight(level, weights.get(level)) == 0)
    caps = leaves.withColumn("cap", F.when(dead, 0).otherwise(F.col("tokens") * max_epochs))
    total = caps.agg(F.sum("tokens").alias("tokens"), F.sum("cap").alias("cap")).first()
    plan = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        nodes = caps.groupBy(*path).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("weight", _weight(level, weights.get(level)))
        if plan is None:
            wanted = (total.tokens or 0) if budget is None else budget
            nodes = nodes.withColumn("budget", F.lit(min(wanted, total.cap or 0)).cast("long"))
        else:
            nodes = nodes.join(plan, path[:-1])
        shared = share_out(nodes, path[:-1], level)
        plan = stored(shared.select(*path, F.col("given").alias("budget")), "mix-budgets")
    return leaves.join(plan, list(LEVELS)).select(*LEVELS, "tokens", F.col("budget").alias("given"))


def mix(
    docs: DataFrame,
    *,
    domain: Column,
    weights: dict[str, Weights],
    budget: int | None = None,
    max_epochs: int = 2,
    seed: int = 17,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Select documents so that tokens follow target weights in a domain-language-source tree.

    ``weights`` maps a level ("domain", "lang", "source") to whole weights by name; names
    not listed weigh 1. ``budget`` is the number of tokens wanted (default: all there are);
    no source is read more than ``max_epochs`` times. A leaf's tokens are taken epoch by
    epoch, each in its own order seeded by ``seed``, the epoch and the id; of the last epoch
    the longest prefix of whole documents that fits is taken.

    Returns the selected rows of ``docs`` with ``domain``, ``n_tokens`` and ``copies`` (how
    often the row is taken); columns of those names are replaced. Null names count as
    "unknown", null ids and texts as empty. A text without a word takes no token and goes
    with its place in the order. Rows of a leaf with equal ids are taken together or not at
    all. A leaf without tokens is not taken. Tokens times the sum of sibling weights must
    fit 64 bits. An empty table gives no rows.

    A leaf may hold any share of the rows: tokens are first summed by the leading digits of
    the order, and only the run of rows on the edge is sorted.
    """
    names = {c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in ("lang", "source")}
    marked = docs.select(
        "*", F.coalesce(domain, F.lit(UNKNOWN)).alias("__domain"),
        names["lang"].alias("__lang"), names["source"].alias("__source"),
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("__id"),
    ).withColumn("__tokens", n_tokens(text_column))
    leaf_names = [F.col(f"__{c}").alias(c) for c in LEVELS]
    slim = stored(
        marked.select(*leaf_names, F.col("__id").alias("id"), F.col("__tokens").alias("tokens")),
        "mix-rows",
    )
    leaves = stored(slim.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    plan = stored(
        leaf_budgets(leaves, budget, max_epochs, weights).where("tokens > 0 AND given > 0")
        .select(*LEVELS, F.expr("given div tokens").alias("full"), F.expr("given % tokens").alias("rest")),
        "mix-plan",
    )

    def turn(full: Column, own: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), full.cast("string"), own).cast("binary"))

    placed = slim.join(plan.where("rest > 0"), list(LEVELS)).select(
        *LEVELS, "tokens", "rest", turn(F.col("full"), F.col("id")).alias("turn")
    ).withColumn("digits", F.substring("turn", 1, DIGITS))
    placed = stored(placed, "mix-placed")
    by_leaf = Window.partitionBy(*LEVELS)
    sums = (
        placed.groupBy(*LEVELS, "digits").agg(F.sum("tokens").alias("own"), F.first("rest").alias("rest"))
        .withColumn("upto", F.sum("own").over(by_leaf.orderBy("digits")))
    )
    edges = stored(  # the first digits whose rows do not all fit
        sums.where("upto > rest").groupBy(*LEVELS).agg(
            F.min("digits").alias("digits"),
            F.min_by(F.col("rest") - F.col("upto") + F.col("own"), "digits").alias("left"),
        ), "mix-edges",
    )
    inside = (
        placed.join(edges, [*LEVELS, "digits"]).groupBy(*LEVELS, "turn", "left")
        .agg(F.sum("tokens").alias("own"))
        .withColumn("upto", F.sum("own").over(by_leaf.orderBy("turn")))
        .where("upto <= left").groupBy(*LEVELS).agg(F.max("turn").alias("cut"))
    )
    cuts = stored(
        plan.join(edges, list(LEVELS), "left").join(inside, list(LEVELS), "left").select(
            *[F.col(c).alias(f"__{c}") for c in LEVELS], "full",
            F.when(F.col("rest") == 0, F.lit("")).otherwise(F.coalesce("cut", "digits", F.lit("g"))).alias("cut"),
        ), "mix-cuts",
    )
    kept = [F.col(c) for c in docs.columns if c not in ("domain", "n_tokens", "copies")]
    cuts = cuts.withColumnsRenamed({"full": "__full", "cut": "__cut"})
    last = (turn(F.col("__full"), F.col("__id")) <= F.col("__cut")).cast("long")
    return (
        marked.join(cuts, [f"__{c}" for c in LEVELS]).withColumn("__copies", F.col("__full") + last)
        .where("__copies > 0")
        .select(*kept, F.col("__domain").alias("domain"), F.col("__tokens").alias("n_tokens"), F.col("__copies").alias("copies"))
    )
