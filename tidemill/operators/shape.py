"""Filters, projections, binning and duplicate removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.scalar import part_after, split_cells


def full_name(df: DataFrame, first: str, last: str, name: str = "full_name") -> DataFrame:
    """``first last``; null when either is null."""
    return df.withColumn(name, F.concat(F.col(first), F.lit(" "), F.col(last)))


def email_domain(df: DataFrame, email: str, name: str = "domain") -> DataFrame:
    """The part of an address after the at sign."""
    return df.withColumn(name, part_after(email, "@"))


def eq_filter(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def prefix_filter(df: DataFrame, column: str, prefix: str, **equal) -> DataFrame:
    """Rows whose text starts with ``prefix`` and whose other columns equal the given values."""
    return df.filter(F.col(column).startswith(prefix) & _all_equal(equal))


def modulo_filter(df: DataFrame, column: str, divisor: int, remainder: int, **equal) -> DataFrame:
    """Rows with ``column % divisor == remainder`` and the given equalities."""
    return df.filter((F.col(column) % divisor == remainder) & _all_equal(equal))


def _all_equal(equal: dict) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c) == F.lit(v) for c, v in equal.items()), F.lit(True))


def before(df: DataFrame, column: str, date: str) -> DataFrame:
    """Rows dated before the given day, written as ``yyyy-MM-dd``."""
    kind = df.schema[column].dataType
    return df.filter(F.col(column) < F.lit(date).cast(kind))


def greater_than(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) > value)


def in_list(df: DataFrame, column: str, values: list, below: dict | None = None) -> DataFrame:
    """Rows whose column is one of ``values``, and whose ``below`` columns are under their limits."""
    found = df.filter(F.col(column).isin(list(values)))
    return reduce(lambda d, item: d.filter(F.col(item[0]) < item[1]), (below or {}).items(), found)


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


# Comparison words of document queries.
_COMPARE = {
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$eq": lambda c, v: c == v,
}


def match(df: DataFrame, spec: dict) -> DataFrame:
    """Document filter: ``{"age": {"$gt": 30, "$lt": 45}}``, ``{"country": "Japan"}``, ``{"$and": [...]}``.

    A document without the field does not match.
    """
    return df.filter(F.coalesce(_predicate(spec), F.lit(False)))


def _predicate(spec: dict) -> Column:
    terms = []
    for field, wanted in spec.items():
        if field == "$and":
            terms += [_predicate(part) for part in wanted]
        elif isinstance(wanted, dict):
            terms += [_COMPARE[word](F.col(field), F.lit(value)) for word, value in wanted.items()]
        else:
            terms.append(F.col(field) == F.lit(wanted))
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def project(df: DataFrame, columns: list[str], hide: list[str] = ("_id",)) -> DataFrame:
    """The named fields; hidden ones stay out even when named."""
    return df.select(*[c for c in columns if c not in hide])


def case_buckets(df: DataFrame, column: str, ranges: list[tuple], name: str = "bucket") -> DataFrame:
    """Labels from inclusive ranges ``(low, high, label)``, tried in turn.

    ``None`` leaves a side open: ``(None, 10, "<10")`` is below 10 and ``(40, None, ">40")`` above 40,
    both without the border. Values in no range get null.
    """
    value = F.col(column)
    chosen = F.lit(None).cast("string")
    for low, high, label in reversed(ranges):
        if low is None:
            inside = value < high
        elif high is None:
            inside = value > low
        else:
            inside = value.between(low, high)
        chosen = F.when(inside, F.lit(label)).otherwise(chosen)
    return df.withColumn(name, chosen)


def validity_state(
    df: DataFrame, start: str, end: str, as_of: str,
    labels: tuple[str, str, str] = ("active", "expired", "not started"),
    name: str = "state", text_compare: bool = False,
) -> DataFrame:
    """Whether ``as_of`` lies within the validity dates of a row.

    The last day counts as valid. ``text_compare`` compares as text instead: ``as_of`` with a time
    of day sorts after the bare last date, which makes that day expired.
    """
    if text_compare:
        low, high, now = F.col(start).cast("string"), F.col(end).cast("string"), F.lit(as_of)
    else:
        low, high, now = F.to_date(start), F.to_date(end), F.to_date(F.lit(as_of))
    active, expired, future = labels
    state = F.when(now.between(low, high), active).when(now > high, expired).when(now < low, future)
    return df.withColumn(name, state)


def bin_column(
    df: DataFrame, column: str, edges: list, labels: list[str],
    include_lowest: bool = False, name: str = "bin",
) -> DataFrame:
    """Label of the right-closed interval ``(edge, next edge]`` of a value; null outside all.

    The lowest edge itself lies in no interval unless ``include_lowest``.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("there must be one label for each interval")
    value, chosen = F.col(column), F.lit(None).cast("string")
    for i, label in enumerate(labels):
        inside = (value > edges[i]) & (value <= edges[i + 1])
        if i == 0 and include_lowest:
            inside = value.between(edges[0], edges[1])
        chosen = F.coalesce(chosen, F.when(inside, F.lit(label)))
    return df.withColumn(name, chosen)


def random_int(df: DataFrame, name: str, low: int, high: int, seed: int | None = None) -> DataFrame:
    """A random whole number from ``low`` to ``high``, both included."""
    span = high - low + 1
    return df.withColumn(name, (F.floor(F.rand(seed) * span) + low).cast("int"))


def reshape(
    df: DataFrame, drop: list[str] = (), rename: dict[str, str] | None = None, order: list[str] | None = None
) -> DataFrame:
    """Drops, then renames, then puts the columns in order."""
    df = df.drop(*drop).withColumnsRenamed(rename or {})
    return df.select(*order) if order else df


def with_params(df: DataFrame, **literals) -> DataFrame:
    """Adds parameter values as columns."""
    return df.withColumns({name: F.lit(value) for name, value in literals.items()})


def over_threshold(
    df: DataFrame, amount: str, base: str, pct: float, use_abs: bool = False, name: str = "threshold"
) -> DataFrame:
    """Rows whose amount is above ``pct`` percent of ``base``.

    Amounts are taken with their sign; ``use_abs`` lets money going out count as well.
    """
    df = df.withColumn(name, F.col(base) * (F.lit(pct) / 100))
    size = F.abs(F.col(amount)) if use_abs else F.col(amount)
    return df.filter(size > F.col(name))


def stamp(df: DataFrame, load_ts, defaults: dict | None = None, name: str = "load_ts") -> DataFrame:
    """Adds the load time and fills missing values with defaults."""
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()}
    when = load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    return df.withColumns({**filled, name: when})


def dedup_rows(df: DataFrame, wide: bool = False) -> DataFrame:
    """Each different row once; copies are merged before the shuffle.

    For ``wide`` rows, such as whole texts, two hashes of the row are counted first. A row whose hashes occur once is
    unlike all others and stays where it is; only the others cross the shuffle as they are.
    """
    if not wide:
        return df.dropDuplicates()
    hashes = df.withColumns({"_h1": F.xxhash64(*df.columns), "_h2": F.hash(*reversed(df.columns))})
    often = hashes.groupBy("_h1", "_h2").agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    alone = hashes.join(often, ["_h1", "_h2"], "left_anti").select(*df.columns)
    return alone.unionByName(hashes.join(often, ["_h1", "_h2"], "left_semi").select(*df.columns).dropDuplicates())


def last_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row of each key that is last in ``order_by``.

    An aggregate, not a window: copies of a hot key are merged in every task before the shuffle.
    """
    row = F.max_by(F.struct(*df.columns), F.struct(*order_by)).alias("_row")
    return df.groupBy(*keys).agg(row).select("_row.*")


def dedup_keys(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The row of each key that is first in ``order_by``."""
    row = F.min_by(F.struct(*df.columns), F.struct(*order_by)).alias("_row")
    return df.groupBy(*keys).agg(row).select("_row.*")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def non_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where all the columns are above zero."""
    return df.filter(reduce(lambda a, b: a & b, (F.col(c) > 0 for c in columns)))


def explode_cell(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """One row for each part of a multi-valued cell."""
    return df.withColumn(column, F.explode(split_cells(column, sep)))
