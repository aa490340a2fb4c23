"""Integrity checks for constraints that files do not enforce."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, MAX_LENGTHS, PRIMARY_KEYS


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphan_rows(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Child rows whose (non-NULL) key has no parent row. ``on`` pairs child and parent columns."""
    renamed = parent.select(*[F.col(p).alias(f"_p{i}") for i, (_, p) in enumerate(on)])
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c, _ in on])
    match = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_p{i}") for i, (c, _) in enumerate(on)])
    return child.where(present).join(renamed, match, "left_anti")


def length_violations(df: DataFrame, limits: dict[str, int], keys: list[str]) -> DataFrame:
    """One row per value longer than its column allows."""
    checks = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.length(c).alias("length"), F.lit(n).alias("max_length"))
        for c, n in limits.items()
    ])
    return df.select(*keys, F.inline(F.filter(checks, lambda x: x["length"] > x["max_length"])))


def stored_length_violations(table: str, df: DataFrame, keys: list[str]) -> DataFrame:
    return length_violations(df, MAX_LENGTHS[table], keys)


def stored_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per stored table and constraint: how many keys repeat, rows have no parent, values are too long."""
    counts = []

    def count(found: DataFrame, table: str, kind: str) -> None:
        counts.append(found.agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), "n"))

    for name, df in tables.items():
        keys = list(PRIMARY_KEYS[name])
        count(duplicate_keys(df, keys), name, "repeated key")
        for columns, parent, parent_columns in FOREIGN_KEYS.get(name, ()):
            count(orphan_rows(df, tables[parent], list(zip(columns, parent_columns))), name, "no parent")
        if name in MAX_LENGTHS:
            count(stored_length_violations(name, df, keys), name, "too long")
    return reduce(DataFrame.unionByName, counts)


def section_gaps(sections: DataFrame, keys: tuple[str, ...] = ("article_id",)) -> DataFrame:
    """Section count per article and whether the ids run without gaps."""
    return sections.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sections"), (F.max("section_id") + 1 == F.count(F.lit(1))).alias("contiguous")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
