"""Data-quality audit: one pass per table, whatever the number of rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.functions.rules import Rule


def audit(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """Report (table, rule, n_rows, n_violations, passed), from one scan of the rules' columns."""
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(rule.broken()).alias(f"broken_{i}") for i, rule in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(table).alias("table"),
                F.lit(rule.name).alias("rule"),
                F.col("n_rows"),
                F.col(f"broken_{i}").alias("n_violations"),
                (F.col(f"broken_{i}") == 0).alias("passed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines))


def audit_from_violations(
    broken: DataFrame, df: DataFrame, rules: Sequence[Rule], table: str
) -> DataFrame:
    """The same report, counted from the stored ``violations`` of the stored table ``df``.

    The rules are not evaluated again: one column of the set-aside rows is grouped, and the number
    of rows of ``df`` comes from its file footers.
    """
    names = F.array(*[F.struct(F.lit(rule.name).alias("rule")) for rule in rules])
    all_rules = df.sparkSession.range(1).select(F.inline(names))
    counts = per_rule(broken.select("rules")).groupBy("rule").agg(F.count("*").alias("found"))
    n_violations = F.coalesce("found", F.lit(0))
    return all_rules.join(counts, "rule", "left").select(
        F.lit(table).alias("table"),
        "rule",
        df.agg(F.count("*")).scalar().alias("n_rows"),
        n_violations.alias("n_violations"),
        (n_violations == 0).alias("passed"),
    )


def combine(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def verdict(report: DataFrame) -> DataFrame:
    """Per table: does every rule hold on every row?"""
    return report.groupBy("table").agg(F.every("passed").alias("passed"))


def violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that break a rule, once each, with the names of the broken rules in ``rules``.

    A row that breaks several rules is not copied; ``per_rule`` lists it once for each. The filter runs in generated code, so that only the broken rows reach the slower listing of
    rule names.
    """
    broken = reduce(lambda a, b: a | b, [rule.broken() for rule in rules])
    names = F.array(*[F.when(rule.broken(), F.lit(rule.name)) for rule in rules])
    return df.where(broken).select("*", F.array_compact(names).alias("rules"))


def per_rule(broken: DataFrame) -> DataFrame:
    """The rows of ``violations`` once per broken rule, with its name in ``rule``."""
    return broken.withColumn("rule", F.explode("rules")).drop("rules")
