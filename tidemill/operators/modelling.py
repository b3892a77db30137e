"""Normal forms, dimensions with surrogate keys, and facts that refer to them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemill.operators.ordering import asc, number_rows, same
from tidemill.operators.shape import dedup_rows
from tidemill.session import materialise


@dataclass(frozen=True)
class Dimension:
    """A dimension found in raw rows: ``columns`` maps raw columns to the dimension's natural key,
    and ``key`` is its surrogate. ``existing`` holds the members known so far."""

    existing: DataFrame
    columns: dict[str, str]
    key: str


def new_members(raw: DataFrame, dim: Dimension) -> DataFrame:
    """The names in the raw rows that the dimension lacks, numbered after its largest key.

    Only unknown names get a number, so known members keep theirs and a rerun adds nothing.
    """
    names = list(dim.columns.values())
    found = raw.select(*[F.col(r).alias(n) for r, n in dim.columns.items()]).dropna(how="all").distinct()
    known = dim.existing.select(*[F.col(n).alias(f"_k_{n}") for n in names])
    unknown = found.join(known, same([found[n] for n in names], [known[f"_k_{n}"] for n in names]), "left_anti")
    # Stored, so that the raw rows are read once and not again for each step of the numbering.
    numbered = number_rows(materialise(unknown, "members"), [asc(n) for n in names], name="_n")
    top = dim.existing.agg(F.coalesce(F.max(F.col(dim.key).cast("long")), F.lit(0).cast("long"))).scalar()
    return numbered.select((F.col("_n") + top).alias(dim.key), *names)


def members(raw: DataFrame, dim: Dimension) -> DataFrame:
    """The dimension with the raw rows' new names added."""
    names = list(dim.columns.values())
    old = dim.existing.select(F.col(dim.key).cast("long").alias(dim.key), *names)
    return old.unionByName(new_members(raw, dim))


def with_key(fact: DataFrame, dim: Dimension, table: DataFrame) -> DataFrame:
    """Adds the surrogate key of ``table`` to the fact; null where the name is null."""
    named = reduce(lambda a, b: a | b, (F.col(r).isNotNull() for r in dim.columns))
    side = table.select(dim.key, *[F.col(n).alias(f"_d_{n}") for n in dim.columns.values()])
    known = fact.filter(named)
    match = same([known[r] for r in dim.columns], [side[f"_d_{n}"] for n in dim.columns.values()])
    found = known.join(side, match, "left").drop(*[f"_d_{n}" for n in dim.columns.values()])
    # Facts without any name stay out of the join, where they would all meet in one task.
    return found.unionByName(fact.filter(~named).withColumn(dim.key, F.lit(None).cast(table.schema[dim.key].dataType)))


def normalise(
    raw: DataFrame, dims: dict[str, Dimension], fact_columns: list[str]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Wide raw rows to updated dimensions and a fact holding their keys."""
    tables = {name: members(raw, dim) for name, dim in dims.items()}
    fact = raw
    for name, dim in dims.items():
        fact = with_key(fact, dim, tables[name])
    return tables, fact.select(*fact_columns)


def split_entities(raw: DataFrame, specs: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Several entities held in one raw table, each row once."""
    return {name: dedup_rows(raw.select(*columns)) for name, columns in specs.items()}


def check_fd(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """Values of ``left`` that go with more than one combination of ``right``; none when the
    dependency holds. Combinations are made unique first, so a hot value is no burden."""
    pairs = df.select(*left, *right).distinct()
    return pairs.groupBy(*left).agg(F.count("*").alias("n_values")).filter(F.col("n_values") > 1)


def decompose(
    df: DataFrame, dependencies: dict[str, tuple[list[str], list[str]]]
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Moves columns that depend on others to tables of their own.

    ``dependencies`` maps a table name to (determining, dependent) columns. The rest keeps the
    determining columns; joining all tables gives the rows back. A dependency that does not hold is an
    error, as the join would then make rows that were not there.
    """
    for name, (left, right) in dependencies.items():
        if not check_fd(df, left, right).isEmpty():
            raise ValueError(f"{', '.join(left)} does not determine {', '.join(right)}, as table {name} needs")
    tables = {n: df.select(*left, *right).distinct() for n, (left, right) in dependencies.items()}
    moved = {c for _, right in dependencies.values() for c in right}
    return df.select(*[c for c in df.columns if c not in moved]).distinct(), tables
