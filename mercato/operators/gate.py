"""Counters taken while a table is written, which decide whether it is published.

The counters ride on the write itself (``DataFrame.observe``), so no second scan
is needed: rows, NULL keys, rows that repeat a key, and violations of contract
rules. Repeated keys are found by numbering the rows of each key: a shuffle of
the rows by key, which a table bucketed on its key does without. Rows without a
key are numbered apart, so they do not meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from mercato.plans.quality import Rule, violations


class GateError(ValueError):
    """The written rows break the contract; nothing was published."""

    def __init__(self, table: str, found: dict[str, int]) -> None:
        super().__init__(f"{table} is not published: " + ", ".join(f"{k} {v:,}" for k, v in sorted(found.items())))
        self.found = found


@dataclass(frozen=True)
class Gate:
    """Key columns, and rules on columns (all kinds but ``unique``, which a key is for)."""

    keys: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()

    def observed(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The rows, and the counters that are there once they have been written."""
        counters = [F.count(F.lit(1)).alias("rows")]
        numbered = df
        if self.keys:
            missing = F.lit(False)
            for k in self.keys:
                missing = missing | F.col(k).isNull()
            apart = F.when(missing, F.xxhash64(*df.columns))
            window = Window.partitionBy(*self.keys, apart).orderBy(*self.keys)
            numbered = df.withColumn("_nth", F.row_number().over(window))
            counters += [
                F.count(F.when(missing, 1)).alias("null_keys"),
                F.count(F.when(~missing & (F.col("_nth") > 1), 1)).alias("repeated_keys"),
            ]
        counters += [violations(r).alias(f"{r.column} {r.name}") for r in self.rules]
        counted = Observation()
        return numbered.observe(counted, *counters).select(*df.columns), counted

    def check(self, table: str, counted: Observation) -> int:
        """The number of rows; :class:`GateError` if any other counter is not zero."""
        found = dict(counted.get)
        rows = found.pop("rows")
        broken = {k: v for k, v in found.items() if v}
        if broken:
            raise GateError(table, broken)
        return rows


def gate_for(schema, keys: Sequence[str]) -> Gate:
    """The gate of a serving contract: its keys, text lengths, number ranges and NOT NULL columns."""
    rules = []
    for f in schema.fields:
        kind = f.dataType.typeName()
        if kind == "varchar":
            rules.append(Rule(f.name, "varchar", length=f.dataType.length))
        elif kind == "decimal":
            rules.append(Rule(f.name, "numeric", precision=f.dataType.precision, scale=f.dataType.scale))
        if not f.nullable and f.name not in keys:
            rules.append(Rule(f.name, "not_null"))
    return Gate(tuple(keys), tuple(rules))
