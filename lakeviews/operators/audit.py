"""Keys, references and counts of many tables, checked in one pass and one exchange.

Every rule turns rows into fingerprints: a unique key's, a child's reference,
a parent's key.  All rules of a table are stacked from one scan of it; all
tables' stacks are united and grouped by (rule, fingerprint), with partial sums
before the one exchange, so a hot key costs a row a task.  What is exchanged is
fixed in width (a 64-bit fingerprint, a count, marks for parents and for keys
with a NULL, the least and greatest of a second fingerprint), however long the
keys are.

Where keys are expected to be unique (``unique``: rows kept by key), a unique
key sends its first fingerprint alone, 12 bytes rather than 27 after
compression.  Keys whose first fingerprints all differ are all different; a rule
with a fingerprint that comes twice is measured again, with both.

Where a group's two second fingerprints differ, different keys share the first
one.  Only these groups' keys are then counted in full, in a second pass that
usually doesn't run.  Two keys are taken for one only if both fingerprints, 128
bits from different seeds, agree.

A Bloom filter of the parents' keys in front of the exchange isn't used: it
tells some orphans early, but every valid reference passes it, and these are
nearly all.  Partial sums reduce both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Unique:
    """Rows beyond the first of a key (NULLs compare equal), rows of keys with a NULL, and the table's rows."""
    table: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Refer:
    """Rows whose non-null column isn't among the parent's."""
    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Count:
    """Rows for which a condition holds."""
    table: str
    condition: Callable[[DataFrame], Column]


@dataclass(frozen=True)
class Total:
    rows: int = 0
    repeated: int = 0
    void: int = 0
    orphans: int = 0


def fingerprints(keys: list[Column]) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds; a NULL differs from every value and equals a NULL."""
    marked = [x for k in keys for x in (k, k.isNull())]
    return F.xxhash64(*marked), F.xxhash64(F.lit("second"), *marked)


def _stack(df: DataFrame, table: str, rules: list, prints, full: bool = False, unique: bool = False) -> DataFrame | None:
    """Rows (rule, one, two, n, void, parent) of all the table's rules; ``full``: and key, the whole key as text; ``unique``: unique keys have no two."""
    out = []

    def entry(number: int, keys: list[Column], n: int, parent: bool, when: Column | None, alone: bool = False) -> None:
        one, two = prints(keys) if keys else (F.lit(0).cast("long"), F.lit(0).cast("long"))
        if alone:
            two = F.lit(None).cast("long")
        void = F.lit(False)
        for k in keys:
            void = void | k.isNull()
        fields = {"rule": F.lit(number), "one": one, "two": two, "n": F.lit(n).cast("long"), "void": void, "parent": F.lit(parent)}
        if full:
            named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
            fields["key"] = F.to_json(F.struct(*named), {"ignoreNullFields": "false"}) if keys else F.lit("")
        out.append(([c.alias(name) for name, c in fields.items()], when))

    for number, rule in enumerate(rules):
        if isinstance(rule, Unique) and rule.table == table:
            entry(number, [F.col(k) for k in rule.keys], 1, False, None, unique)
        elif isinstance(rule, Count) and rule.table == table:
            entry(number, [], 1, False, rule.condition(df))
        elif isinstance(rule, Refer):
            for owner, column, n, parent in ((rule.table, rule.column, 1, False), (rule.parent, rule.parent_column, 0, True)):
                if owner == table:
                    entry(number, [F.col(column).cast("string")], n, parent, F.col(column).isNotNull())
    if len(out) == 1:
        fields, when = out[0]
        return (df if when is None else df.filter(when)).select(*fields)
    rows = [F.struct(*fields) if when is None else F.when(when, F.struct(*fields)) for fields, when in out]
    return df.select(F.inline(F.array(*rows))).filter("rule IS NOT NULL") if rows else None


def _united(frames: dict[str, DataFrame], rules: list, prints, full: bool = False, unique: bool = False) -> DataFrame | None:
    stacks = [s for s in (_stack(df, name, rules, prints, full, unique) for name, df in frames.items()) if s is not None]
    out = stacks[0] if stacks else None
    for s in stacks[1:]:
        out = out.unionByName(s)
    return out


def grouped(frames: dict[str, DataFrame], rules: list, prints=fingerprints, unique: bool = False) -> DataFrame:
    """(rule, one, n, void, parent, same), one row for each fingerprint of each rule: the one exchange."""
    return (_united(frames, rules, prints, unique=unique).groupBy("rule", "one")
            .agg(F.sum("n").alias("n"), F.max("void").alias("void"), F.max("parent").alias("parent"), F.min("two").alias("least"), F.max("two").alias("most"))
            .select("rule", "one", "n", "void", "parent", F.coalesce(F.col("least") == F.col("most"), F.lit(True)).alias("same")))


def _sums(rows: DataFrame, same: Column) -> DataFrame:
    counted = F.col("n") > 0
    return rows.groupBy("rule").agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(same & counted, F.col("n") - 1)), F.lit(0)).alias("repeated"),
                                    F.coalesce(F.sum(F.when(same & F.col("void"), F.col("n"))), F.lit(0)).alias("void"),
                                    F.coalesce(F.sum(F.when(same & ~F.col("parent"), F.col("n"))), F.lit(0)).alias("orphans"),
                                    F.count_if(~same).alias("shared"))


def audit(frames: dict[str, DataFrame], rules: list, prints=fingerprints, unique: bool = False) -> list[Total]:
    """The totals of every rule, in order; its tables must be among ``frames``.  ``unique``: keys are expected to be so, which changes the cost and no total."""
    if not rules or _united(frames, rules, prints) is None:
        return [Total() for _ in rules]
    groups = grouped(frames, rules, prints, unique)
    # A row a rule.
    found = {r["rule"]: r for r in _sums(groups, F.col("same")).collect()}
    totals = [Total(r["rows"], r["repeated"], r["void"], r["orphans"]) if (r := found.get(k)) else Total() for k in range(len(rules))]
    again = [k for k, rule in enumerate(rules) if unique and isinstance(rule, Unique) and totals[k].repeated]
    for k, total in zip(again, audit(frames, [rules[k] for k in again], prints)):
        totals[k] = total
    shared = [k for k, r in found.items() if r["shared"]]
    if not shared:
        return totals
    colliding = groups.filter(~F.col("same")).select("rule", "one")
    whole = (_united(frames, rules, prints, True, unique).filter(F.col("rule").isin(shared)).join(colliding, ["rule", "one"], "left_semi")
             .groupBy("rule", "key").agg(F.sum("n").alias("n"), F.max("void").alias("void"), F.max("parent").alias("parent")))
    for r in _sums(whole, F.lit(True)).collect():
        t = totals[r["rule"]]
        totals[r["rule"]] = Total(t.rows, t.repeated + r["repeated"], t.void + r["void"], t.orphans + r["orphans"])
    return totals
