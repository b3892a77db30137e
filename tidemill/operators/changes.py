"""Row changes as new frames: insert-ignore, upsert, batch update, delete.

Each takes the target as it is and returns it as it should be; ``sources.sinks.overwrite`` puts
the result in place. Only the incoming rows are made unique, by an aggregate that merges copies of
a hot key before the shuffle; the target goes through one join and no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.operators.joins import not_in
from tidemill.operators.shape import dedup_keys, last_per_key


def new_rows(target: DataFrame, new: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The rows an insert would add: first of each key in ``new``, when not in ``target``. A null in a
    key is a value like others, so a repeat adds nothing."""
    first = dedup_keys(new, keys, order_by or new.columns)
    return not_in(first, target, keys, null_safe=True).select(*target.columns)


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Adds rows with unknown keys; known keys stay untouched."""
    return target.unionByName(new_rows(target, new, keys, order_by))


def upsert(target: DataFrame, new: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Adds unknown keys and replaces known ones; of several new rows the last in ``order_by`` wins.

    A null in a key is a value like others, so a repeat changes nothing."""
    last = last_per_key(new, keys, order_by).select(*target.columns)
    return not_in(target, last, keys, null_safe=True).unionByName(last)


def replace_by_key(target: DataFrame, row: DataFrame, keys: list[str]) -> DataFrame:
    """Delete, then insert: the key's old rows go, the given rows come, also when there were none."""
    return not_in(target, row, keys).unionByName(row.select(*target.columns))


def batch_update(
    target: DataFrame, updates: DataFrame, key: str, column: str, order_by: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Sets ``column`` for the listed keys; of several updates to a key the last counts.

    Also returns a report with a row per key: ``updated`` is false where the target has no such key.
    """
    last = last_per_key(updates, [key], order_by)
    values = last.select(F.col(key), F.struct(column).alias("_new"))
    joined = target.join(values, key, "left")
    value = F.when(F.col("_new").isNotNull(), F.col(f"_new.{column}")).otherwise(F.col(column))
    changed = joined.withColumn(column, value).select(*target.columns)
    known = target.select(F.col(key).alias("_known")).join(last.select(F.col(key).alias("_known")), "_known", "left_semi").distinct()
    report = last.join(known, last[key] == known["_known"], "left").select(
        last[key], F.col("_known").isNotNull().alias("updated")
    )
    return changed, report


def update_counts(report: DataFrame) -> DataFrame:
    """How many listed keys were updated and how many are unknown."""
    return report.agg(
        F.count_if(F.col("updated")).alias("n_updated"), F.count_if(~F.col("updated")).alias("n_unknown")
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows left after a delete; rows where the condition is null stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))
