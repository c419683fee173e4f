"""Declarative data checks, foreign-key validation and the gate behind them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberfold.operators.joins import MAX_BROADCAST_ROWS, lookup_join

SUCCESS = "Success"
FAILURE = "Failure"


class QualityGateError(ValueError):
    """A constraint failed."""


@dataclass(frozen=True)
class ForeignKey:
    """``column`` of the fact refers to ``parent_key`` of ``parent``."""

    column: str
    parent: DataFrame
    parent_key: str


def _is_one(metric: Column) -> Column:
    return metric == 1.0


@dataclass
class Check:
    """Constraints of one table. Every method returns the check for chaining."""

    name: str
    ratios: list[tuple[str, Column, Callable[[Column], Column]]] = field(default_factory=list)
    uniques: list[tuple[str, str]] = field(default_factory=list)
    parents: list[tuple[str, ForeignKey]] = field(default_factory=list)

    def is_complete(self, *columns: str) -> Check:
        for c in columns:
            self.ratios.append((f"complete({c})", F.col(c).isNotNull(), _is_one))
        return self

    def has_completeness(self, column: str, holds: Callable[[Column], Column]) -> Check:
        self.ratios.append((f"completeness({column})", F.col(column).isNotNull(), holds))
        return self

    def satisfies(self, predicate: str, label: str) -> Check:
        """Share of rows for which the SQL predicate is true; NULL counts as false."""
        self.ratios.append((label, F.coalesce(F.expr(predicate), F.lit(False)), _is_one))
        return self

    def is_unique(self, *columns: str) -> Check:
        """Share of non-NULL values that occur exactly once."""
        for c in columns:
            self.uniques.append((f"unique({c})", c))
        return self

    def has_parent(self, label: str, key: ForeignKey) -> Check:
        """Share of rows whose foreign key exists in the parent."""
        self.parents.append((label, key))
        return self

    def __len__(self) -> int:
        return len(self.ratios) + len(self.uniques) + len(self.parents)


def _ratio_results(checks: Sequence[tuple[DataFrame, Check]]) -> list[DataFrame]:
    """Shares of all completeness and predicate constraints of all tables.

    Every table turns its rows into flags, and one aggregate averages the flags
    of all tables. Each table comes with a row of NULLs, which keeps an empty
    table present.
    """
    checks = [(df, check) for df, check in checks if check.ratios]
    if not checks:
        return []
    names, holding, frames, seeds = [], {}, [], []
    columns = [f"m{k}" for k in range(max(len(check.ratios) for _, check in checks))]
    nothing = F.lit(None).cast("double")
    for df, check in checks:
        flags = [flag.cast("double") for _, flag, _ in check.ratios]
        flags += [nothing] * (len(columns) - len(flags))
        group = [F.lit(len(names)).alias("first"), F.lit(len(check.ratios)).alias("many")]
        frames.append(df.select(*group, *[f.alias(m) for f, m in zip(flags, columns)]))
        seeds.append(F.struct(*group))
        for label, _, holds in check.ratios:
            if holds is not _is_one:
                holding[len(names)] = holds
            names.append((check.name, label))
    empty = checks[0][0].sparkSession.range(1).select(F.inline(F.array(*seeds))).select(
        "*", *[nothing.alias(m) for m in columns])
    shares = reduce(DataFrame.unionByName, frames, empty).groupBy("first", "many").agg(
        *[F.avg(m).alias(m) for m in columns])
    metrics = shares.select("first", "many", F.posexplode(F.array(*columns)).alias("at", "metric"))
    return [named_results(
        metrics.where("at < many").select((F.col("first") + F.col("at")).alias("i"), "metric"),
        names, holding)]


def _key_counts(cells: Sequence[tuple[DataFrame, Sequence[tuple[int, Column]]]],
                kind: str) -> DataFrame:
    """Rows per key value, ``i, key, n``, for keys numbered ``i`` over many tables.

    Each table is read once and reduced on the map side, so neither its width
    nor a hot key reaches the shuffle. Every ``i`` comes with a NULL key, which
    keeps it present for an empty table.
    """
    seeds = cells[0][0].sparkSession.range(1).select(F.explode(F.array(
        *[F.lit(i) for _, keys in cells for i, _ in keys])).alias("i"))
    parts = [seeds.select("i", F.lit(None).cast(kind).alias("key"), F.lit(0).alias("w"))]
    for df, keys in cells:
        pairs = F.array(*[
            F.struct(F.lit(i).alias("i"), c.cast(kind).alias("key")) for i, c in keys])
        parts.append(df.select(F.inline(pairs)).withColumn("w", F.lit(1)))
    return reduce(DataFrame.unionByName, parts).groupBy("i", "key").agg(F.sum("w").alias("n"))


def named_results(metrics: DataFrame, names: Sequence[tuple[str, str]],
                   holding: Mapping[int, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Results from ``i, metric``, where ``names[i]`` holds check and constraint.

    A constraint holds at 1 unless ``holding`` has another condition for it.
    """
    i, metric = F.col("i"), F.col("metric")
    holds = metric == 1.0
    for at, condition in (holding or {}).items():
        holds = F.when(i == at, condition(metric)).otherwise(holds)
    check, constraint = (
        F.get(F.array(*[F.lit(name[at]) for name in names]), i) for at in (0, 1))
    return metrics.select(
        check.alias("check"), constraint.alias("constraint"), metric,
        F.when(holds, F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("constraint_status"))


def _key_kind(df: DataFrame, column: str) -> str:
    kind = df.schema[column].dataType.simpleString()
    return "bigint" if kind in ("tinyint", "smallint", "int", "bigint") else kind


def _unique_results(checks: Sequence[tuple[DataFrame, Check]]) -> list[DataFrame]:
    """All unique keys of all tables, in one count per type of key."""
    by_kind: dict[str, list[tuple[int, str, str]]] = {}
    for t, (df, check) in enumerate(checks):
        for label, c in check.uniques:
            by_kind.setdefault(_key_kind(df, c), []).append((t, label, c))
    results = []
    n, known = F.col("n"), F.col("key").isNotNull()
    for kind, keys in by_kind.items():
        cells = [
            (checks[t][0], [(i, F.col(c)) for i, (u, _, c) in enumerate(keys) if u == t])
            for t in dict.fromkeys(t for t, _, _ in keys)]
        metrics = _key_counts(cells, kind).groupBy("i").agg(F.try_divide(
            F.sum(F.when(known & (n == 1), 1).otherwise(0)),
            F.sum(F.when(known, n).otherwise(0))).alias("metric"))
        results.append(named_results(
            metrics, [(checks[t][1].name, label) for t, label, _ in keys]))
    return results


def _parent_results(checks: Sequence[tuple[DataFrame, Check]]) -> list[DataFrame]:
    """All foreign keys of all facts, per type of key: counts per value meet the parents' keys.

    Parent keys that cannot have the fact's type match nothing. A parent that serves several facts is read and joined once.
    """
    by_kind: dict[str, list[tuple[int, str, ForeignKey]]] = {}
    for t, (df, check) in enumerate(checks):
        for label, fk in check.parents:
            by_kind.setdefault(_key_kind(df, fk.column), []).append((t, label, fk))
    results = []
    for kind, keys in by_kind.items():
        parents: dict[tuple[int, str], DataFrame] = {}
        parent_of = []
        for _, _, fk in keys:
            place = (id(fk.parent), fk.parent_key)
            parents.setdefault(place, fk.parent.select(F.lit(len(parents)).alias("p"), F.col(
                fk.parent_key).try_cast(kind).alias("key")))
            parent_of.append(list(parents).index(place))
        cells = [
            (checks[t][0], [(i, F.col(fk.column)) for i, (u, _, fk) in enumerate(keys) if u == t])
            for t in dict.fromkeys(t for t, _, _ in keys)]
        known = reduce(DataFrame.union, parents.values()).distinct().withColumn("found", F.lit(True))
        counts = _key_counts(cells, kind).withColumn(
            "p", F.get(F.array(*[F.lit(p) for p in parent_of]), F.col("i")))
        metrics = counts.join(known, ["p", "key"], "left").groupBy("i").agg(
            F.try_divide(F.sum(F.when(F.col("found"), F.col("n")).otherwise(0)), F.sum("n")).alias(
                "metric"))
        results.append(named_results(metrics, [(checks[t][1].name, label) for t, label, _ in keys]))
    return results


def run_checks(checks: Sequence[tuple[DataFrame, Check]]) -> DataFrame:
    """Results as ``check, constraint, metric, constraint_status``.

    One aggregate over all tables for completeness and predicate constraints,
    one count for all unique keys of a type, one for all foreign keys. The
    metrics of an empty table are NULL, and fail.
    """
    return reduce(DataFrame.unionByName, [
        *_ratio_results(checks), *_unique_results(checks), *_parent_results(checks)])


def gate(results: DataFrame) -> None:
    """Raise if any constraint failed. Reads at most one row per constraint."""
    failed = results.where(F.col("constraint_status") != SUCCESS).collect()
    if failed:
        listed = "; ".join(f"{r['check']}: {r['constraint']} = {r['metric']}" for r in failed)
        raise QualityGateError(f"{len(failed)} constraints failed: {listed}")


def foreign_key_flags(df: DataFrame, flags: Mapping[str, ForeignKey],
                      max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Add one column per foreign key: 1 if the parent exists, else 0.

    Keys may have any type, that of the fact counts. Joins against the distinct parent keys
    alone, so no row is multiplied, and the facts are scanned once in the result.
    """
    facts = df
    for name, key in flags.items():
        kind = _key_kind(df, key.column)
        known = key.parent.select(
            F.col(key.parent_key).try_cast(kind).alias("_fk")).where(
            F.col("_fk").isNotNull()).distinct().withColumn("_found", F.lit(1))
        fk = F.col(key.column).cast(kind).alias("_fk")
        joined = lookup_join(df.withColumn("_fk", fk), known, ["_fk"], max_broadcast_rows,
                             stored=False, keys=facts.select(fk))
        df = joined.withColumn(name, F.coalesce(F.col("_found"), F.lit(0))).drop("_fk", "_found")
    return df


def orphans(df: DataFrame, key: ForeignKey,
            max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Rows whose foreign key has no parent, NULL keys included."""
    flagged = foreign_key_flags(df, {"_valid": key}, max_broadcast_rows)
    return flagged.where(F.col("_valid") == 0).drop("_valid")
