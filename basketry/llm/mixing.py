"""Operator 10 - mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree of domain, language and source.  A node can
take its tokens times ``max_epochs`` at most, and its share of the parent's
budget follows its weight among its siblings.  What a node cannot take goes to
its siblings by their weights first; only what all children of a parent cannot
take together is a shortage of the parent, which its own siblings take.  Each
leaf then reads whole epochs of its documents, and of the last epoch the
longest prefix, in that epoch's seeded order, within the tokens that are left.

The tree holds one row per leaf, so the allocation is a few window functions
over a small table.  The prefix is not found by sorting a leaf: its documents
are cut into 4,096 hash cells in the epoch's order, the cells' totals give
offsets, and running sums are taken inside the cells.  A leaf's selection is
then a threshold on the hash, so documents join the leaf table alone and their
texts are not shuffled by this operator unless the leaf table is itself large.

Amounts are whole tokens in exact arithmetic.  Defined results: null keys make
a node of their own, written ``(none)``; documents without tokens are never
selected; repeated rows tie and are taken or left together; a weight of 0
takes nothing; an empty table selects nothing; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, Workspace

LEVELS = ["domain", "lang", "source"]
CELL_DIGITS = 3  # 16**3 cells


@dataclass(frozen=True)
class Mixture:
    """Weights are whole numbers; a node without one has ``default``."""

    domains: dict[str, str] = field(default_factory=lambda: {"src0": "web"})
    other_domain: str = "curated"
    weights: tuple[dict[str, int], ...] = (
        {"web": 40, "curated": 60},
        {"en": 55, "de": 15, "fr": 15, "es": 15},
        {},
    )
    default: int = 10
    budget_percent: int = 80  # of the tokens there are
    max_epochs: int = 2
    seed: int = 11


def n_tokens(text: str = "text") -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(F.col(text), SPACE, -1), "")), F.lit(0)).cast("long")


def node_columns(mix: Mixture) -> list[Column]:
    lookup = F.lit(mix.other_domain)
    for source, domain in sorted(mix.domains.items()):
        lookup = F.when(F.col("source") == source, F.lit(domain)).otherwise(lookup)
    named = [lookup, F.col("lang"), F.col("source")]
    return [F.coalesce(c.cast("string"), F.lit("(none)")).alias(f"__{k}") for c, k in zip(named, LEVELS, strict=True)]


def epoch_hash(mix: Mixture, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), F.col("doc_id").cast("string")))


def _weight(level: int, mix: Mixture) -> Column:
    out = F.lit(mix.default)
    for name, w in sorted(mix.weights[level].items()):
        out = F.when(F.col(f"__{LEVELS[level]}") == name, F.lit(w)).otherwise(out)
    return out.cast("decimal(38,0)")


def share_out(nodes: DataFrame, parent: list[str], order: list[str]) -> DataFrame:
    """Water-filling among siblings.  ``nodes`` has ``__b`` (the parent's
    budget), ``__w`` and ``__cap``; ``__take`` is added.  Siblings in order of
    cap over weight fill up while their share of what is left exceeds their
    cap; the rest divide what remains by weight, rounded down."""
    key = [F.col(c) for c in parent] or [F.lit(0)]
    by_ratio = Window.partitionBy(*key).orderBy((F.col("__cap").cast("double") / F.col("__w").cast("double")),
                                                 *[F.col(c) for c in order])
    before, after, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(
        0, Window.unboundedFollowing), Window.partitionBy(*key)
    zero = F.lit(0).cast("decimal(38,0)")
    full = F.col("__cap") * F.col("__wleft") <= F.col("__w") * (F.col("__b") - F.col("__used"))
    out = (
        nodes.withColumn("__used", F.coalesce(F.sum("__cap").over(before), zero).cast("decimal(38,0)"))
        .withColumn("__wleft", F.sum("__w").over(after).cast("decimal(38,0)"))
        .withColumn("__full", full)
        .withColumn("__left", F.col("__b") - F.coalesce(F.sum(F.when(F.col("__full"), F.col("__cap"))).over(whole), zero))
        .withColumn("__wsum", F.sum(F.when(~F.col("__full"), F.col("__w"))).over(whole).cast("decimal(38,0)"))
        .withColumn("__take", F.when(F.col("__full"), F.col("__cap")).otherwise(
            F.expr("cast((cast(__left as decimal(38,0)) * __w) div __wsum as decimal(38,0))")))
    )
    return out.drop("__used", "__wleft", "__full", "__left", "__wsum")


def allocate(leaves: DataFrame, mix: Mixture) -> DataFrame:
    """``leaves`` (node columns, __t tokens) with ``__take``: its tokens."""
    cols = [f"__{c}" for c in LEVELS]
    dec = "decimal(38,0)"
    for i in range(len(LEVELS)):
        leaves = leaves.withColumn(f"__w{i}", _weight(i, mix))
    usable = leaves.filter(" and ".join(f"__w{i} > 0" for i in range(len(LEVELS)))).withColumn(
        "__cap", (F.col("__t") * mix.max_epochs).cast(dec))
    total = leaves.agg(F.coalesce(F.sum("__t"), F.lit(0)).alias("__all"))
    top = usable.agg(F.coalesce(F.sum("__cap"), F.lit(0)).cast(dec).alias("__most")).crossJoin(F.broadcast(total)).select(
        F.least(F.col("__most"), F.expr(f"__all * {mix.budget_percent} div 100").cast(dec)).cast(dec).alias("__b"))
    plan = top
    for i in range(len(LEVELS)):
        nodes = usable.groupBy(*cols[:i + 1]).agg(
            F.sum("__cap").cast(dec).alias("__cap"), F.first(f"__w{i}").alias("__w"))
        nodes = nodes.crossJoin(F.broadcast(plan)) if i == 0 else nodes.join(plan, cols[:i])  # one row at the top
        plan = share_out(nodes, cols[:i], cols[:i + 1]).select(*cols[:i + 1], F.col("__take").alias("__b"))
    return leaves.select(*cols, "__t").join(plan.withColumnRenamed("__b", "__take"), cols)


def leaf_plan(docs: DataFrame, mix: Mixture) -> DataFrame:
    """Per leaf: ``__epochs`` whole epochs and ``__cut``, the largest epoch
    hash its last prefix takes (null: none).  Staged, so that later joins know
    its size and broadcast it only when it is small."""
    cols = [f"__{c}" for c in LEVELS]
    ws = Workspace(docs.sparkSession, "mixing")
    small = ws.stage(docs.select(F.col("doc_id").cast("long"), *node_columns(mix), n_tokens().alias("__n")).filter("__n > 0"), "counts")
    leaves = small.groupBy(*cols).agg(F.sum("__n").alias("__t"))
    quota = ws.stage(allocate(leaves, mix).select(
        *cols, F.expr("cast(__take div __t as int)").alias("__epochs"),
        F.expr("cast(__take % __t as long)").alias("__rest")), "quota")
    dated = small.join(quota, cols).withColumn("__h", epoch_hash(mix, F.col("__epochs"))).withColumn(
        "__cell", F.substring("__h", 1, CELL_DIGITS))
    cell = dated.groupBy(*cols, "__cell").agg(F.sum("__n").alias("__c"))
    before = Window.partitionBy(*cols).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offset = cell.select(*cols, "__cell", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__o"))
    # ties (repeated rows) share a running sum: the default frame is by range
    inside = Window.partitionBy(*cols, "__cell").orderBy("__h")
    taken = (
        dated.withColumn("__run", F.sum("__n").over(inside)).join(offset, [*cols, "__cell"])
        .filter(F.col("__o") + F.col("__run") <= F.col("__rest"))
        .groupBy(*cols).agg(F.max("__h").alias("__cut"))
    )
    plan = ws.stage(quota.join(taken, cols, "left").select(*cols, "__epochs", "__cut"), "plan")
    ws.drop("counts", "quota")
    return plan


def select_mixture(docs: DataFrame, mix: Mixture | None = None, with_epoch: bool = False) -> DataFrame:
    """The selected rows with all columns of ``docs``, once per epoch that
    takes them.  On request ``epoch``, ``domain`` and ``n_tokens`` are added,
    in place of columns of those names."""
    mix = mix or Mixture()
    cols = [f"__{c}" for c in LEVELS]
    plan = leaf_plan(docs, mix)
    last = epoch_hash(mix, F.col("__epochs")) <= F.col("__cut")
    epochs = F.col("__epochs") + F.coalesce(last, F.lit(False)).cast("int")
    out = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", *node_columns(mix),
                    n_tokens().alias("__n")).filter("__n > 0").join(plan, cols)
        .withColumn("__times", epochs).filter("__times > 0")
        .withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__times") - 1)))
    )
    extra = [F.col("__epoch").alias("epoch"), F.col("__domain").alias("domain"), F.col("__n").alias("n_tokens")]
    added = ["epoch", "domain", "n_tokens"] if with_epoch else []
    return out.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns if c not in added], *(extra if with_epoch else []))
