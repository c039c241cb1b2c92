"""G1: data quality rules as distributed jobs.

- Row rules (not-null, range, allowed set, regex, SQL expression) are evaluated in ONE
  aggregation: one ``count_if`` per rule, partially aggregated on every task, so the
  shuffle carries one row per task whatever the table size. The wide result is turned
  into one row per rule with ``inline`` (JVM-side).
- Uniqueness is a grouped count with map-side combine: a hot key collapses to one row per
  task before the shuffle.
- Foreign keys are checked on distinct keys: the child's keys (de-duplicated map-side)
  ``left_anti`` the parent's keys give the orphan keys, which are counted and then fetch
  the orphan rows by a semi-join, broadcast under a counted bound (so the child table is
  not shuffled), a shuffle join with AQE skew splitting above it.
- ``check_rules`` plans a whole rule list: all row rules in one aggregation, and all unique and
  foreign-key rules together in a second one. For these every row becomes a (rule, hashed key) pair
  per rule, counted on every task before one shuffle; a parent's distinct keys join those counts,
  not the rows. Keys are hashed to 128 bits, in a type that holds child and parent.
Null values pass every rule except ``not_null`` (a null foreign key is not an orphan, a key with a
null part is not repeated).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.reconcile import common_type

ROW_RULE_KINDS = ("not_null", "range", "allowed", "regex", "expression")
KEY_RULE_KINDS = ("unique", "foreign_key")


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    column: str | None = None
    min: Any = None
    max: Any = None
    allowed: tuple = ()
    pattern: str | None = None
    expression: str | None = None
    # unique, foreign_key: the key's columns (``column`` for a single one), and for a foreign key the
    # parent's dataset id (or frame) and its key columns, where they have other names
    columns: tuple = ()
    parent: Any = None
    parent_columns: tuple = ()

    @property
    def key(self) -> list[str]:
        return list(self.columns or ([self.column] if self.column else []))

    def failing(self) -> Column:
        """True where the row breaks the rule."""
        if self.kind == "expression":
            return ~F.coalesce(F.expr(self.expression), F.lit(True))
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "range":
            ok = F.lit(True)
            if self.min is not None:
                ok = ok & (c >= F.lit(self.min))
            if self.max is not None:
                ok = ok & (c <= F.lit(self.max))
            return c.isNotNull() & ~ok
        if self.kind == "allowed":
            return c.isNotNull() & ~c.isin(list(self.allowed))
        if self.kind == "regex":
            return c.isNotNull() & ~c.rlike(self.pattern)
        raise ValueError(f"unknown rule kind {self.kind!r}")


def check_row_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``rule_name, rule_type, column_name, checked_rows, failed_rows, passed``."""
    if not rules:
        raise ValueError("no rules given")
    aggs = [F.count(F.lit(1)).alias("_checked")]
    aggs += [F.count_if(r.failing()).alias(f"_f{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    entries = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule_name"),
            F.lit(r.kind).alias("rule_type"),
            F.lit(r.column).cast("string").alias("column_name"),
            F.col("_checked").alias("checked_rows"),
            F.col(f"_f{i}").alias("failed_rows"),
        )
        for i, r in enumerate(rules)
    ])
    return wide.select(F.inline(entries)).withColumn("passed", F.col("failed_rows") == 0)


def failing_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that break at least one rule, with the names of the broken rules.

    Rows are first filtered by the OR of the rule predicates (whole-stage generated code);
    the list of broken rule names (a lambda ``filter``, evaluated row by row) is built only
    for the rows that fail."""
    if not rules:
        raise ValueError("no rules given")
    any_failing = rules[0].failing()
    for r in rules[1:]:
        any_failing = any_failing | r.failing()
    names = F.array(*[F.when(r.failing(), F.lit(r.name)) for r in rules])
    return df.where(any_failing).withColumn("failed_rules", F.filter(names, lambda x: x.isNotNull()))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_foreign_key(df: DataFrame, keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose (non-null) key has no match in ``parent``.

    Keys are checked, not rows: the child's distinct keys (de-duplicated on every task
    before the shuffle, so a hot key is one row per task) are anti-joined with the parent's
    keys. The orphan keys are materialised and counted; the child's rows are then fetched
    with a semi-join that broadcasts the orphan keys when their measured bytes are under a bound
    (``broadcasts.small_side``) - the child table itself is never shuffled in that case."""
    from quayside.operators.broadcasts import small_side
    from quayside.session import checkpoint_root

    keys, parent_keys = list(keys), list(parent_keys or keys)
    ref = parent.select(*[F.col(p).alias(f"_ref_{i}") for i, p in enumerate(parent_keys)]).distinct()
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    child = df.where(not_null)
    child_keys = child.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).distinct()
    cond = [F.col(f"_key_{i}") == F.col(f"_ref_{i}") for i in range(len(keys))]
    checkpoint_root(df.sparkSession)
    orphans = child_keys.join(ref, cond, "left_anti").checkpoint(eager=True)
    return child.join(small_side(orphans), [F.col(k) == F.col(f"_key_{i}") for i, k in enumerate(keys)], "left_semi")


def _hashed_key(names: Sequence[str], own: Sequence[T.DataType], wide: Sequence[T.DataType]) -> list[Column]:
    """(key without nulls, two 64-bit hashes of the key in the types ``wide``)."""
    there, parts = F.lit(True), []
    for n, a, b in zip(names, own, wide):
        c = F.col(f"`{n}`")
        v = c if a == b else c.try_cast(b)
        there = there & c.isNotNull()
        parts += [v, F.when(v.isNull(), c.cast("string"))]  # the text of what has no value in the wider type
    return [there, F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)]


def check_key_rules(df: DataFrame, rules: Sequence[Rule], parent: Callable[[Any], DataFrame] = lambda p: p) -> DataFrame:
    """Unique and foreign-key rules, one row per rule as ``check_row_rules``: one pass over ``df``
    and one over each parent's key columns. A unique rule fails for every row of a repeated key.
    ``parent`` gives the frame of a rule's ``parent``."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    entries = [F.struct(F.lit(-1).alias("i"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))]  # every row
    parents: DataFrame | None = None
    for i, r in enumerate(rules):
        if not r.key:
            raise ValueError(f"rule {r.name!r} names no columns")
        own = wide = [kinds[c] for c in r.key]
        if r.kind == "foreign_key":
            ref = parent(r.parent)
            names = list(r.parent_columns or r.key)
            theirs = {f.name: f.dataType for f in ref.schema.fields}
            wide = [common_type(x, theirs[n]) for x, n in zip(own, names)]
            there, a, b = _hashed_key(names, [theirs[n] for n in names], wide)
            known = ref.where(there).select(F.lit(i).alias("i"), a.alias("a"), b.alias("b")).distinct().withColumn("known", F.lit(True))
            parents = known if parents is None else parents.union(known)
        elif r.kind != "unique":
            raise ValueError(f"unknown key rule kind {r.kind!r}")
        there, a, b = _hashed_key(r.key, own, wide)
        entries.append(F.when(there, F.struct(F.lit(i).alias("i"), a.alias("a"), b.alias("b"))))
    pairs = df.select(F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("x")).select("x.*")
    counts = pairs.groupBy("i", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.join(parents, ["i", "a", "b"], "left") if parents is not None else counts.withColumn("known", F.lit(None).cast("boolean"))
    unique = F.col("i").isin([i for i, r in enumerate(rules) if r.kind == "unique"])
    broken = F.when(unique, F.col("n") > 1).otherwise(F.col("known").isNull())
    aggs = [F.coalesce(F.sum(F.when(F.col("i") == -1, F.col("n"))), F.lit(0)).alias("_checked")]
    aggs += [F.coalesce(F.sum(F.when((F.col("i") == i) & broken, F.col("n"))), F.lit(0)).alias(f"_f{i}") for i in range(len(rules))]
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.kind).alias("rule_type"), F.lit(",".join(r.key)).alias("column_name"),
                 F.col("_checked").alias("checked_rows"), F.col(f"_f{i}").alias("failed_rows"))
        for i, r in enumerate(rules)
    ])
    return counts.agg(*aggs).select(F.inline(rows)).withColumn("passed", F.col("failed_rows") == 0)


def check_rules(df: DataFrame, rules: Sequence[Rule], parent: Callable[[Any], DataFrame] = lambda p: p) -> DataFrame:
    """One report row per rule, of any kind."""
    if not rules:
        raise ValueError("no rules given")
    row_rules, key_rules = split_rules(rules)
    out = check_row_rules(df, row_rules) if row_rules else None
    if key_rules:
        keys = check_key_rules(df, key_rules, parent)
        out = keys if out is None else out.unionByName(keys)
    return out


def split_rules(rules: Sequence[Rule]) -> tuple[list[Rule], list[Rule]]:
    """(row rules, key rules)."""
    return [r for r in rules if r.kind not in KEY_RULE_KINDS], [r for r in rules if r.kind in KEY_RULE_KINDS]
