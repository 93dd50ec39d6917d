"""Differences between two copies of a dataset.

Rows are tagged with their side, united and grouped once by key; each side's
current row is kept as one struct and the structs are compared field by field
with generated higher-order expressions.

Defined results
---------------
* strings are compared trimmed of plain spaces; null differs from '' and from an
  empty list; NaN equals NaN;
* a null struct holds null in all its fields; null list entries equal each other;
* rows with a null key are ignored; ties of the load time are taken as equal;
* an empty side gives ``only_a`` or ``only_b`` for every key of the other;
* columns that are not compared may have any name and type.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.operators.current import age

RTOL = 1e-3


def same_text(a: Column, b: Column) -> Column:
    return F.trim(a).eqNullSafe(F.trim(b))


def same_value(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def same_number(a: Column, b: Column, rtol: float = RTOL) -> Column:
    near = F.abs(a - b) <= F.lit(rtol) * F.greatest(F.abs(a), F.abs(b))
    return a.eqNullSafe(b) | F.coalesce(near, F.lit(False))


def same_list(entry: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    """Lists agree entry by entry, in order."""

    def same(a: Column, b: Column) -> Column:
        each = F.zip_with(a, b, lambda x, y: (x.isNull() & y.isNull()) | F.coalesce(x.isNotNull() & y.isNotNull() & entry(x, y), F.lit(False)))
        both = (F.size(a) == F.size(b)) & F.forall(each, lambda x: x)
        return (a.isNull() & b.isNull()) | F.coalesce(a.isNotNull() & b.isNotNull() & both, F.lit(False))

    return same


def same_struct(**fields: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    def same(a: Column, b: Column) -> Column:
        out = F.lit(True)
        for name, entry in fields.items():
            out = out & entry(a.getField(name), b.getField(name))
        return out

    return same


def same_map(entry: Callable[[Column, Column], Column]) -> Callable[[Column, Column], Column]:
    """Maps agree key by key; an absent key differs from a null value."""

    def same(a: Column, b: Column) -> Column:
        one = F.forall(F.map_entries(a), lambda e: F.map_contains_key(b, e["key"]) & entry(e["value"], F.element_at(b, e["key"])))
        return (F.size(a) == F.size(b)) & one

    return same


def as_set(values: Column) -> Column:
    """Trimmed entries without null and blank ones, sorted, each once."""
    listed = F.coalesce(values, F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))))


@dataclass(frozen=True)
class Field:
    """A compared field: its path in the result, where it stands, and its equality."""

    path: str
    same: Callable[[Column, Column], Column] = same_text
    value: Column | None = None

    def column(self) -> Column:
        return F.col(self.path) if self.value is None else self.value

    @property
    def slot(self) -> str:
        return self.path.replace(".", "__")


def diff_copies(
    a: DataFrame,
    b: DataFrame,
    fields: list[Field],
    key: str = "id",
    loaded: str = "loaded_at",
    key_name: str = "element_id",
) -> DataFrame:
    """(key_name, finding): ``only_a``, ``only_b`` or the path of a differing field."""

    def tagged(df: DataFrame, left: bool) -> DataFrame:
        held = F.struct(*(f.column().alias(f.slot) for f in fields))
        return df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.lit(left).alias("left"), age(loaded).alias("t"), held.alias("v"))

    both = tagged(a, True).unionByName(tagged(b, False))
    sides = both.groupBy("k").agg(
        F.max_by("v", F.when(F.col("left"), F.col("t"))).alias("a"),
        F.max_by("v", F.when(~F.col("left"), F.col("t"))).alias("b"),
    )
    found = F.array(*(F.when(~f.same(F.col(f"a.{f.slot}"), F.col(f"b.{f.slot}")), F.lit(f.path)) for f in fields))
    finding = (
        F.when(F.col("b").isNull(), F.array(F.lit("only_a")))
        .when(F.col("a").isNull(), F.array(F.lit("only_b")))
        .otherwise(F.filter(found, lambda x: x.isNotNull()))
    )
    return sides.select(F.col("k").alias(key_name), F.explode(finding).alias("finding"))


_condition = same_struct(parameter=same_text, operator=same_text, value_num=same_number, value_str=same_text, unit=same_text)

#: The compared fields of an element.
ELEMENT_FIELDS = [
    *(Field(p) for p in ("type", "title", "description", "parent_id", "source.section", "source.citation")),
    Field("source.page", same_value),
    *(Field(f"data.{p}") for p in ("rule", "then_text", "term", "definition", "expression", "target")),
    Field("data.conditions", same_list(_condition)),
    Field("data.columns", same_list(same_struct(name=same_text, unit=same_text))),
    Field("data.rows", same_list(same_map(same_text))),
    Field("cross_references", lambda x, y: as_set(x).eqNullSafe(as_set(y))),
]
