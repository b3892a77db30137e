"""Normal forms derived from functional dependencies.

The rules work on column names only; the data is asked whether the dependencies hold, with a shuffle for each
determining side, and is split and joined back by Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemill.operators.ordering import same

Dependency = tuple[frozenset[str], frozenset[str]]


class BrokenDependency(ValueError):
    """Rows contradict a dependency; ``rows`` holds them."""

    def __init__(self, message: str, rows: DataFrame):
        super().__init__(message)
        self.rows = rows


def depends(left: str, right: str) -> Dependency:
    """``depends("a b", "c d")``: a and b together determine c and d."""
    return frozenset(left.split()), frozenset(right.split())


def closure(columns: frozenset[str], dependencies: list[Dependency]) -> frozenset[str]:
    """All columns that ``columns`` determine."""
    known = set(columns)
    while True:
        more = {c for left, right in dependencies if left <= known for c in right} - known
        if not more:
            return frozenset(known)
        known |= more


def minimal_cover(dependencies: list[Dependency]) -> list[Dependency]:
    """The same dependencies with one dependent column each, no determining column to spare and none that follows from
    the others."""
    single = sorted({(left, c) for left, right in dependencies for c in right - left}, key=lambda d: (sorted(d[0]), d[1]))
    rules = [(left, frozenset([c])) for left, c in single]
    for i, (left, right) in enumerate(rules):
        for c in sorted(left):
            if len(left) > 1 and right <= closure(left - {c}, rules):
                left = left - {c}
        rules[i] = (left, right)
    for rule in list(rules):
        others = [r for r in rules if r is not rule]
        if rule[1] <= closure(rule[0], others):
            rules = others
    return rules


def candidate_key(columns: list[str], dependencies: list[Dependency]) -> frozenset[str]:
    """Columns that determine all others and of which none can be left out; earlier columns are preferred."""
    key = frozenset(columns)
    for c in reversed(columns):
        if frozenset(columns) <= closure(key - {c}, dependencies):
            key -= {c}
    return key


def third_normal_form(columns: list[str], dependencies: list[Dependency]) -> list[list[str]]:
    """Column lists of tables in third normal form that keep all dependencies and join back without loss: one for each
    determining side of the minimal cover, and one with a key if none holds it."""
    cover = minimal_cover(dependencies)
    sides = list(dict.fromkeys(left for left, _ in cover))
    tables = [left | {c for l, right in cover if l == left for c in right} for left in sides]
    loose = frozenset(columns) - frozenset().union(*tables) if tables else frozenset(columns)
    key = candidate_key(columns, dependencies)
    if loose or not any(key <= t for t in tables):
        tables.append(key | loose)
    whole = [t for i, t in enumerate(tables) if not any(t < o or (t == o and j < i) for j, o in enumerate(tables))]
    return [[c for c in columns if c in t] for t in whole]


def broken(df: DataFrame, dependencies: list[Dependency]) -> list[tuple[Dependency, DataFrame]]:
    """The dependencies that do not hold, with the rows of determining values that go with several dependent ones.

    Pairs are made unique before they are counted, so a hot value is no burden; nulls are values like others."""
    found = []
    for left, right in dependencies:
        keys = sorted(left)
        pairs = df.select(*keys, *sorted(right - left)).distinct()
        torn = pairs.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1") if keys else pairs.agg(F.count("*").alias("_n")).filter("_n > 1")
        if not torn.isEmpty():
            side = torn.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
            rows = df.join(side, same([df[k] for k in keys], [side[f"_t_{k}"] for k in keys]), "left_semi") if keys else df
            found.append(((left, right), rows))
    return found


def split(df: DataFrame, dependencies: list[Dependency]) -> list[DataFrame]:
    """The tables of the third normal form, each row once. Dependencies that the rows contradict are an error that holds
    the rows."""
    wrong = broken(df, dependencies)
    if wrong:
        (left, right), rows = wrong[0]
        raise BrokenDependency(f"{', '.join(sorted(left))} does not determine {', '.join(sorted(right))}", rows)
    return [df.select(*names).distinct() for names in third_normal_form(df.columns, dependencies)]


def join_back(tables: list[DataFrame], columns: list[str]) -> DataFrame:
    """The rows that were split, each once: tables are joined on the columns they share, the one that holds most first."""
    rest = sorted(tables, key=lambda t: -len(t.columns))
    found = rest.pop(0)
    while rest:
        table = next((t for t in rest if set(t.columns) & set(found.columns)), rest[0])
        rest.remove(table)
        shared = [c for c in table.columns if c in found.columns]
        side = table.select(*[F.col(c).alias(f"_j_{c}" if c in shared else c) for c in table.columns])
        match = same([found[c] for c in shared], [side[f"_j_{c}"] for c in shared])
        found = found.join(side, match).drop(*[f"_j_{c}" for c in shared])
    return found.select(*columns)


def lossless(df: DataFrame, tables: list[DataFrame]) -> bool:
    """Whether the tables join back to just the rows of ``df``, each once; a sum of row hashes is compared, not sorted rows."""
    def digest(rows: DataFrame) -> tuple:
        h = F.xxhash64(*df.columns)
        return tuple(rows.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())

    return digest(df.distinct()) == digest(join_back(tables, df.columns))


def dependency_names(dependencies: list[Dependency]) -> list[str]:
    return [f"{' '.join(sorted(left))} -> {' '.join(sorted(right))}" for left, right in dependencies]


def broken_report(df: DataFrame, dependencies: list[Dependency]) -> DataFrame:
    """One row for each dependency: its name and how many determining values go with several dependent ones."""
    reports = []
    for (left, right), name in zip(dependencies, dependency_names(dependencies)):
        pairs = df.select(*sorted(left), *sorted(right - left)).distinct()
        torn = pairs.groupBy(*sorted(left)).agg(F.count("*").alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("n_broken"))
        reports.append(torn.select(F.lit(name).alias("dependency"), "n_broken"))
    return reduce(DataFrame.unionByName, reports)
