"""Ordered steps over a typed table, and checks of its closed value sets.

Every step is a function DataFrame -> DataFrame for ``df.transform``, so a chain of
them stays one projection over one filter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vectorloom.functions import numeric as fn
from vectorloom.plans.spec import FeatureSpec
from vectorloom.sources.delimited import split_fields

Step = Callable[[DataFrame], DataFrame]

TIME_FIELDS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
}


def drop_columns(*names: str) -> Step:
    return lambda df: df.drop(*names)


def filter_not_in_set(column: str, allowed: list[str]) -> Step:
    """Remove rows whose value is not one of ``allowed``; NULL is removed too."""
    return lambda df: df.filter(F.col(column).isin(allowed))


def conditional_replace(column: str, condition: Column, value) -> Step:
    return lambda df: df.withColumn(column, F.when(condition, F.lit(value)).otherwise(F.col(column)))


def rename_column(old: str, new: str) -> Step:
    return lambda df: df.withColumnRenamed(old, new)


def string_to_time(column: str, pattern: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Step:
    """Parse to a timestamp read as UTC, whatever the session's zone."""
    return lambda df: df.withColumn(column, F.to_timestamp_ntz(F.col(column), F.lit(pattern)))


def derive_time_fields(column: str, **fields: str) -> Step:
    """Add integer columns, e.g. ``derive_time_fields("ts", HourOfDay="hour")``."""
    return lambda df: df.withColumns({name: TIME_FIELDS[field](F.col(column)) for name, field in fields.items()})


def transform_process(df: DataFrame, steps: list[Step]) -> DataFrame:
    return reduce(DataFrame.transform, steps, df)


@dataclass(frozen=True)
class Rule:
    """A named condition that every non-NULL value of a column must meet."""

    column: str
    name: str
    holds: Column


def closed_set(column: str, values: list[str]) -> list[Rule]:
    return [Rule(column, "in_set", F.col(column).isin(values))]


def bounded_double(column: str, low: float | None = None, high: float | None = None) -> list[Rule]:
    """Bounds, and neither NaN nor infinite."""
    c = F.col(column)
    rules = [Rule(column, "not_nan", ~F.isnan(c)), Rule(column, "not_infinite", F.abs(c) != float("inf"))]
    if low is not None:
        rules.append(Rule(column, "at_least", c >= low))
    if high is not None:
        rules.append(Rule(column, "at_most", F.isnan(c) | (c <= high)))
    return rules


def numeric_text(column: str) -> list[Rule]:
    """Text that is a number once blanks are cut off; blank text is no value."""
    c = F.col(column)
    return [Rule(column, "is_number", ~fn.has_content(c).isNotNull() | fn.number_value(c).isNotNull())]


def field_count(line: str, spec: FeatureSpec) -> list[Rule]:
    """Lines that split into as many fields as the spec has columns."""
    return [Rule(line, "field_count", F.size(split_fields(F.col(line), spec)) == len(spec.columns))]


def typed_schema_check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Violations per rule, counted in one scan."""
    rows = [
        F.struct(
            F.lit(r.column).alias("column_name"),
            F.lit(r.name).alias("rule"),
            F.count(r.column).alias("n_checked"),
            F.count_if(~r.holds).alias("n_violations"),
        )
        for r in rules
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def violating_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [~r.holds for r in rules]))


def observe_checks(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, Observation]:
    """``df`` with the rules counted as its rows pass by, for whatever is made of it; see ``observed_violations``.

    The counts come from the pass that writes or collects the result, so nothing is read twice. Rows that a later
    filter drops are counted; a limit that stops early leaves rows uncounted.
    """
    observation = Observation()
    counts = [F.count(r.column).alias(f"checked {i}") for i, r in enumerate(rules)]
    counts += [F.count_if(~r.holds).alias(f"violated {i}") for i, r in enumerate(rules)]
    return df.observe(observation, *counts), observation


def observed_violations(spark: SparkSession, observation: Observation, rules: list[Rule]) -> DataFrame:
    """What ``typed_schema_check`` gives, from the pass that has run; waits for it if it has not ended."""
    # one row per rule
    found = observation.get
    rows = [(r.column, r.name, found[f"checked {i}"], found[f"violated {i}"]) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "column_name string, rule string, n_checked bigint, n_violations bigint")
