"""Data contracts: what a table must look like before anything downstream reads it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str
    nullable: bool = True
    low: str | None = None
    high: str | None = None


@dataclass(frozen=True)
class Contract:
    """Columns in order, with an optional unique key over the whole table."""

    columns: tuple[ColumnRule, ...]
    unique_key: tuple[str, ...] = ()

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{c.name}` {c.type}" for c in self.columns)

    def row_rules(self, schema: StructType | None = None) -> list[tuple[str, str, Column]]:
        """(rule, column, broken) for every rule that one row can break by itself.

        The input may hold the declared types, their text, or other types; ``broken`` is never NULL.
        The type rule is also broken where the declared type would hold another value: 3.7 is not
        an INT, nor a moment within a day a DATE. ``schema`` is that of the input.
        """
        rules = []
        for c in self.columns:
            raw, value = F.col(c.name), F.col(c.name).try_cast(c.type)
            changed = F.lit(False)
            if schema is not None and c.name in schema.names:
                kind = schema[c.name].dataType
                exact = {"date": "timestamp", "int": "decimal(38,12)", "bigint": "decimal(38,12)", "smallint": "decimal(38,12)"}
                if not isinstance(kind, StringType):
                    changed = ~value.try_cast(kind).eqNullSafe(raw)
                elif c.type.lower() in exact:
                    changed = ~value.try_cast(exact[c.type.lower()]).eqNullSafe(raw.try_cast(exact[c.type.lower()]))
            rules.append(("type", c.name, raw.isNotNull() & (value.isNull() | changed)))
            if not c.nullable:
                rules.append(("not_null", c.name, raw.isNull()))
            if c.low is not None:
                rules.append(("low", c.name, F.coalesce(value < F.lit(c.low).cast(c.type), F.lit(False))))
            if c.high is not None:
                rules.append(("high", c.name, F.coalesce(value > F.lit(c.high).cast(c.type), F.lit(False))))
        return rules

    def first_broken_rule(self, schema: StructType | None = None) -> Column:
        """Name of the first broken rule as ``rule:column``, NULL for a good row."""
        return F.coalesce(*[F.when(broken, F.lit(f"{rule}:{name}")) for rule, name, broken in self.row_rules(schema)])

    def typed(self) -> dict[str, Column]:
        return {c.name: F.col(c.name).try_cast(c.type) for c in self.columns}


SALES_CONTRACT = Contract(
    columns=(
        ColumnRule("date", "date", nullable=False),
        ColumnRule("store", "int", nullable=False, low="1"),
        ColumnRule("item", "int", nullable=False, low="1"),
        ColumnRule("sales", "bigint", nullable=False, low="0"),
    ),
    unique_key=("date", "store", "item"),
)
