"""Multi-step column expressions in which a step may be used more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Names = Callable[[str], Column]
Steps = list[tuple[str, Callable[[Names], Column]]]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def staged(df: DataFrame, value: Column, steps: Steps,
           result: Callable[[Names], dict[str, Column]]) -> DataFrame:
    """The steps as working columns of a frame, which keeps them in generated code."""
    prefix = "__step_"

    def named(name: str) -> Column:
        return F.col(prefix + name)

    out = df.withColumn(prefix + "input", value)
    for name, step in steps:
        out = out.withColumn(prefix + name, step(named))
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[column.alias(name) for name, column in result(named).items()])


def staged_items(df: DataFrame, column: str, steps: Steps) -> DataFrame:
    """The steps for every item of an array of structs, which gain a field per step.

    Each item starts with a field named ``input``. One flat pass over the array
    per step keeps the expression shallow, where nesting the steps would not.
    """
    fields = list(df.schema[column].dataType.elementType.names)
    out = df
    for name, step in steps:
        known = tuple(fields)
        out = out.withColumn(column, F.transform(F.col(column), lambda item: F.struct(
            *[item[k].alias(k) for k in known],
            step(item.__getitem__).alias(name))))
        fields.append(name)
    return out
