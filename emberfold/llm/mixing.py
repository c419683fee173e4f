"""Token budgets for the leaves of a domain-language-source tree, and what fills them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.storage import materialize

# Documents that one slice of a leaf's seeded order holds on average.
SLICE_ROWS = 2_000
_HASH_TOP = 1 << 60


def word_count(text: Column) -> Column:
    """Words between ASCII white space; NULL counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def seeded_place(key: Column, seed: int, epoch: int | Column) -> Column:
    """A place between 0 and 2**60 for a key in an epoch, from an MD5 digest."""
    name = F.concat_ws("|", F.lit(str(seed)), F.lit(epoch) if isinstance(epoch, int) else epoch,
                       F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def _share(children: DataFrame, parents: Sequence[str], node: str) -> DataFrame:
    """Water-filling: split each parent's ``budget`` among its children.

    Children have ``weight`` and ``capacity``. Those whose capacity is the smallest for their
    weight are filled first; whoever is full leaves its unused share to its siblings, by
    weight. A budget above the capacity of all siblings stays with the ancestors, which
    never hand down more than the children can hold.
    """
    ratio = F.col("capacity") / F.col("weight")
    order = Window.partitionBy(*parents).orderBy(ratio, F.col(node))
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    taken = F.coalesce(F.sum("capacity").over(above), F.lit(0))
    full = F.col("capacity") * F.col("_w") <= F.col("weight") * (F.col("budget") - F.col("_c"))
    marked = children.withColumns({"_c": taken, "_w": F.sum("weight").over(rest)})
    marked = marked.withColumn("_full", full)
    # once a child is not full, none after it is: all of them share what is left
    first = Window.partitionBy(*parents)
    part = F.when(~F.col("_full"), F.struct("_c", "_w"))
    marked = marked.withColumn("_s", F.min(part).over(first))
    given = F.floor(F.col("weight") * (F.col("budget") - F.col("_s._c")) / F.col("_s._w"))
    return marked.withColumn(
        "budget", F.when(F.col("_full"), F.col("capacity")).otherwise(
            F.least(F.col("capacity"), given))).drop("_c", "_w", "_full", "_s")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], total: int, max_epochs: int,
                 weights: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """``budget`` in tokens for each leaf; ``leaves`` has one row per leaf with ``tokens``.

    ``weights[level][value]`` are whole numbers, 1 where none is given; zero and below
    shut a node out. Budgets are passed down
    level by level; a shortage goes to siblings first.
    """
    weights = weights or {}
    tree = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    parents: list[str] = ["_top"]
    budgets = tree.agg(F.least(F.lit(total).cast("bigint"), F.coalesce(F.sum("capacity"), F.lit(0))).alias(
        "budget")).withColumn("_top", F.lit(0))
    tree = tree.withColumn("_top", F.lit(0))
    for level in levels:
        given = weights.get(level, {})
        weight = F.lit(1).cast("bigint")
        if given:
            weight = F.coalesce(F.create_map(*[F.lit(x) for kv in given.items() for x in kv])[
                F.col(level)], F.lit(1)).cast("bigint")
        nodes = tree.groupBy(*parents, level).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("capacity", F.when(weight > 0, F.col("capacity")).otherwise(0))
        nodes = nodes.withColumn("weight", F.greatest(weight, F.lit(1).cast("bigint")))
        on = [F.col(f"n.{p}").eqNullSafe(F.col(f"b.{p}")) for p in parents]
        joined = nodes.alias("n").join(budgets.alias("b"), on).select("n.*", "b.budget")
        budgets = _share(joined, parents, level).select(*parents, level, "budget")
        parents = [*parents, level]
    on = [F.col(f"n.{p}").eqNullSafe(F.col(f"b.{p}")) for p in levels]
    return tree.drop("_top", "capacity").alias("n").join(budgets.alias("b"), on).select(
        "n.*", "b.budget")


def mix(df: DataFrame, levels: Sequence[str], total: int | None = None, share: float = 0.5,
        weights: Mapping[str, Mapping[str, int]] | None = None, max_epochs: int = 4,
        seed: int = 7, id_col: str = "doc_id", tokens_col: str = "tokens",
        slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The documents, with epochs, that meet the leaves' budgets.

    ``df`` has the id, the columns ``levels`` from the root of the tree down, and a token
    count. The budget is ``total`` tokens, or ``share`` of all. A leaf reads epoch after
    epoch, each in its own seeded order, until its budget is met: whole epochs first,
    then a prefix of the next. Returns ``levels``, the id, ``tokens``, ``epoch`` and
    ``start``, the tokens of that leaf and epoch before the document. The document in which the
    budget ends is returned whole.

    A NULL level value is a node like any other, NULL weights count as 1, a NULL
    or negative token count as 0; documents without tokens come with the prefix they stand in. Equal
    places in the order are settled by the id, then the count; rows equal in both share a
    place and go together. An empty table gives no rows.
    """
    counted = F.greatest(F.coalesce(F.col(tokens_col).cast("bigint"), F.lit(0)), F.lit(0))
    rows = materialize(df.select(
        *[F.col(c).cast("string").alias(f"_l{k}") for k, c in enumerate(levels)],
        F.col(id_col).alias("_id"), counted.alias("_n")), "mix-rows")
    keys = [f"_l{k}" for k in range(len(levels))]
    leaves = rows.groupBy(*keys).agg(F.sum("_n").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = materialize(leaves, "mix-leaves")
    if total is None:
        total = int((leaves.agg(F.sum("tokens")).first()[0] or 0) * share)
    given = {f"_l{k}": (weights or {}).get(c, {}) for k, c in enumerate(levels)}
    plan = leaf_budgets(leaves, keys, total, max_epochs, given).where(F.col("budget") > 0)
    # every epoch a leaf touches, with what it takes of it and the slices of its order
    epoch = F.explode(F.sequence(F.lit(0).cast("bigint"),
                                 F.ceil(F.col("budget") / F.col("tokens")) - 1)).alias("epoch")
    reads = plan.select(*keys, "tokens", "docs", "budget", epoch).select(
        *keys, "epoch", F.least(F.col("tokens"), F.col("budget") - F.col("epoch") * F.col("tokens"))
        .alias("wanted"), F.ceil(F.col("docs") / slice_rows).alias("slices"))
    reads = materialize(reads, "mix-reads")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    placed = rows.alias("d").join(reads.alias("r"), same).select(
        *[f"d.{k}" for k in keys], "_id", "_n", "epoch", "wanted",
        seeded_place(F.col("_id"), seed, F.col("epoch")).alias("_p"), "slices")
    width = F.floor(F.lit(_HASH_TOP) / F.col("slices")) + 1
    placed = materialize(placed.withColumn("_s", F.floor(F.col("_p") / width)), "mix-placed")
    sums = placed.groupBy(*keys, "epoch", "_s").agg(F.sum("_n").alias("held"))
    before = Window.partitionBy(*keys, "epoch").orderBy("_s").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.withColumn("_b", F.coalesce(F.sum("held").over(before), F.lit(0)))
    on = [F.col(f"p.{k}").eqNullSafe(F.col(f"s.{k}")) for k in [*keys, "epoch", "_s"]]
    reached = placed.alias("p").join(sums.alias("s"), on).select("p.*", "_b").where(
        F.col("_b") < F.col("wanted"))
    inside = Window.partitionBy(*keys, "epoch", "_s").orderBy("_p", "_id", "_n")
    start = F.col("_b") + F.coalesce(
        F.sum("_n").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        - F.sum("_n").over(Window.partitionBy(*keys, "epoch", "_s", "_p", "_id", "_n")), F.lit(0))
    return reached.withColumn("start", start).where(F.col("start") < F.col("wanted")).select(
        *[F.col(k).alias(c) for k, c in zip(keys, levels)], F.col("_id").alias(id_col),
        F.col("_n").alias("tokens"), "epoch", "start")
