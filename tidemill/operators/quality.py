"""Data-quality rules as boolean columns: one pass over the rows, whatever their number."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemill.functions.scalar import blank, too_long


@dataclass(frozen=True)
class Rule:
    """``holds`` is true for a good row; null counts as a failure."""

    message: str
    holds: Column


def positive_int(column: str) -> Rule:
    return Rule(f"{column} must be a whole number above 0", F.col(column).try_cast("bigint") > 0)


def positive_number(column: str) -> Rule:
    """NaN and infinity are no numbers."""
    value = F.col(column).try_cast("double")
    return Rule(f"{column} must be a number above 0", (value > 0) & (value < float("inf")) & ~F.isnan(value))


def typed_cells(schema: StructType) -> list[Rule]:
    """A cell must fit its column's type: what passes can be cast."""
    return [
        Rule(f"{f.name} must be of type {f.dataType.simpleString()}", F.col(f.name).try_cast(f.dataType).isNotNull())
        for f in schema.fields
    ]


def not_blank(column: str) -> Rule:
    return Rule(f"{column} must not be blank", ~blank(column))


def parses_as_time(column: str) -> Rule:
    return Rule(f"{column} must be a date or time", F.col(column).try_cast("timestamp").isNotNull())


def required(column: str) -> Rule:
    return Rule(f"{column} is required", F.col(column).isNotNull())


def max_length(column: str, limit: int) -> Rule:
    return Rule(f"{column} must be at most {limit} long", F.coalesce(~too_long(column, limit), F.lit(True)))


def whole_number(column: str) -> Rule:
    return Rule(f"{column} must be a whole number", F.col(column).try_cast("bigint").isNotNull())


def between(column: str, low, high) -> Rule:
    """As a CHECK: null passes."""
    holds = F.coalesce(F.col(column).between(low, high), F.lit(True))
    return Rule(f"{column} must be from {low} to {high}", holds)


def one_of(column: str, values: list) -> Rule:
    """As a CHECK: null passes."""
    holds = F.coalesce(F.col(column).isin(list(values)), F.lit(True))
    return Rule(f"{column} must be one of {', '.join(map(str, values))}", holds)


# Rule sets by table name. Lists, ranges and the length limit are fixed values.
def _rules() -> dict[str, list[Rule]]:
    return {
        "products": [positive_int("product_id"), not_blank("product_name")],
        "orders": [positive_int("order_id"), parses_as_time("order_date")],
        "order_items": [
            positive_int("order_id"), positive_int("product_id"),
            positive_int("quantity"), positive_number("price"),
        ],
        "users": [
            required("user_id"), max_length("user_id", 20), required("name"), required("surname"),
            whole_number("age"), required("email"), required("phone"),
        ],
        "cards": [required("card_number"), required("user_id")],
        "promocodes": [
            required("code"), between("discount_percent", 1, 100), required("valid_from"),
            required("valid_to"), one_of("is_active", [0, 1]),
        ],
        "student_homework": [required("status"), one_of("status", ["submitted", "late", "graded"])],
        "students_courses": [
            required("status"), one_of("status", ["active", "paused", "completed", "canceled"]),
            one_of("payment_status", ["paid", "unpaid", "refunded"]),
        ],
        "course_reviews": [required("rating"), between("rating", 1, 5)],
        "grades": [between("id", 0, 10)],
    }


def rules_for(table: str) -> list[Rule]:
    """The rules of a table; an unknown name is an error."""
    rules = _rules()
    if table not in rules:
        raise ValueError(f"no rules for table {table}")
    return rules[table]


def errors_of(rules: list[Rule]) -> Column:
    """Messages of the rules a row breaks."""
    broken = [F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(r.message)) for r in rules]
    return F.array_compact(F.array(*broken))


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows that break a rule, each with all its messages in ``errors``."""
    return df.withColumn("errors", errors_of(rules)).filter(F.size("errors") > 0)


def split_valid(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their ``errors``."""
    good = reduce(lambda a, b: a & b, (F.coalesce(r.holds, F.lit(False)) for r in rules), F.lit(True))
    return df.filter(good), validate(df, rules)


def error_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows broken per message, in one aggregate; only broken rules come out."""
    return validate(df, rules).select(F.explode("errors").alias("message")).groupBy("message").agg(
        F.count("*").alias("n_rows")
    )


def check_not_empty(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("the table is empty")


def check_duplicates(df: DataFrame, wide: bool = False) -> DataFrame:
    """Rows that occur more than once, with their number.

    For ``wide`` rows, such as whole texts, two hashes of the row are counted first, and only rows
    whose hashes repeat cross the shuffle as they are.
    """
    if wide:
        hashes = df.withColumns({"_h1": F.xxhash64(*df.columns), "_h2": F.hash(*reversed(df.columns))})
        often = hashes.groupBy("_h1", "_h2").agg(F.count("*").alias("_n")).filter("_n > 1")
        df = hashes.join(often, ["_h1", "_h2"], "left_semi").select(*df.columns)
    return df.groupBy(*df.columns).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def check_nulls(df: DataFrame) -> DataFrame:
    """One row with the number of nulls in every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def unique_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keys that occur more than once. As in SQL, keys with a null are never equal."""
    return check_duplicates(df.select(*columns).dropna())


def check_constraints(
    df: DataFrame, checks: list[Rule] = (), unique: list[list[str]] = ()
) -> DataFrame:
    """One row per constraint, with the rows that break a check or the surplus rows of a key."""
    counts = [F.count_if(~F.coalesce(r.holds, F.lit(False))) for r in checks]
    reports = []
    if checks:
        pairs = [F.struct(F.lit(r.message).alias("name"), n.alias("n")) for r, n in zip(checks, counts)]
        found = df.agg(F.array(*pairs).alias("all")).select(F.explode("all").alias("x"))
        reports.append(found.select(F.col("x.name").alias("rule"), F.col("x.n").alias("n_broken")))
    for columns in unique:
        name = f"{', '.join(columns)} must be unique"
        surplus = unique_violations(df, columns).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)))
        reports.append(surplus.toDF("n_broken").select(F.lit(name).alias("rule"), "n_broken"))
    return reduce(DataFrame.unionByName, reports)
