"""Grouped reports. All aggregates combine before the shuffle, so a hot key sends little."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.scalar import mean_money, month_start, seconds_between, weekday_name
from tidemill.operators.joins import join_roles, left_default
from tidemill.operators.ordering import MAX_GROUP_ROWS, rank_rows
from tidemill.operators.shape import case_buckets


def value_counts(df: DataFrame, columns: list[str], name: str = "n") -> DataFrame:
    """Rows per value, most frequent first; rows with a null are not counted."""
    return df.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias(name)).orderBy(F.desc(name), *columns)


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def with_empty_bins(counts: DataFrame, labels: list[str], bin: str, fill: dict) -> DataFrame:
    """Adds the bins that got no rows, in the order of ``labels``."""
    wanted = counts.sparkSession.createDataFrame(list(enumerate(labels)), f"bin_no int, {bin} string")
    return left_default(wanted, counts, bin, fill).orderBy("bin_no")


def mean_where(df: DataFrame, column: str, condition: Column | None = None, name: str = "mean") -> DataFrame:
    df = df if condition is None else df.filter(condition)
    return df.agg(F.avg(column).alias(name))


def mean_by(df: DataFrame, column: str, key: str, name: str = "mean") -> DataFrame:
    return df.groupBy(key).agg(F.avg(column).alias(name))


def count_where(df: DataFrame, keys: list[str], condition: Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(condition).alias(name))


def bucket_report(df: DataFrame, column: str, ranges: list[tuple], condition: Column) -> DataFrame:
    """Count, lowest, highest and conditional count in each range of ``case_buckets``."""
    return case_buckets(df, column, ranges).groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.min(column).alias("lowest"),
        F.max(column).alias("highest"),
        F.count_if(condition).alias("n_where"),
    )


def round_mean(df: DataFrame, column: str, keys: list[str] = (), digits: int = 0, name: str = "mean") -> DataFrame:
    """Rounded mean with the row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.avg(column), digits).alias(name))


def shares(df: DataFrame, key: str, category: str, values: dict[str, str]) -> DataFrame:
    """Percent of a key's rows in each category; ``values`` maps a category to its column name."""
    percent = [
        (F.count_if(F.col(category) == value) * F.lit(100.0) / F.count("*")).alias(name)
        for value, name in values.items()
    ]
    return df.groupBy(key).agg(*percent)


def spread(df: DataFrame, key: str, column: str, digits: int = 2) -> DataFrame:
    """Lowest, highest, mean and range of a fixed-point column by key."""
    mean = F.round(F.sum(column) / F.count(column), digits)
    return df.groupBy(key).agg(
        F.min(column).alias("lowest"),
        F.max(column).alias("highest"),
        mean.alias("mean"),
        (F.max(column) - F.min(column)).alias("difference"),
    )


def monthly(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """Rows, sum and mean of a fixed-point amount by month."""
    return df.groupBy(month_start(ts).alias("month")).agg(
        F.count("*").alias("n"), F.sum(amount).alias("total"), mean_money(amount).alias("mean")
    )


def distinct_by(df: DataFrame, key: str, column: str) -> DataFrame:
    """Rows and different values by key; values are made unique before they meet at the key."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(column).alias("n_distinct"))


def having(df: DataFrame, keys: list[str], condition: Column, name: str = "n") -> DataFrame:
    """Groups whose row count, named ``name``, passes the condition."""
    return count_by(df, keys, name).filter(condition)


# How the parts of an aggregate are merged: each by its own rule.
_MERGE = {"sum": (F.sum, F.sum), "count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def grouping_sets(
    df: DataFrame, columns: list[str], sets: list[list[str]], totals: dict[str, tuple[str, Column | str]]
) -> DataFrame:
    """Several groupings in one pass, with totals as ``{"n": ("count", "*")}``; ``grouping_id`` tells a
    total from a null.

    Rows are first grouped by all the columns, so each set is built from the few grouped rows and
    not from a copy of all the facts. Sums, counts, minima and maxima can be merged so; any other
    aggregate is an error.
    """
    unknown = sorted({kind for kind, _ in totals.values()} - set(_MERGE))
    if unknown:
        raise ValueError(f"{', '.join(unknown)} cannot be merged from its groups")
    grouped = df.groupBy(*columns).agg(*[_MERGE[kind][0](value).alias(name) for name, (kind, value) in totals.items()])
    merged = [_MERGE[kind][1](name).alias(name) for name, (kind, _) in totals.items()]
    return grouped.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("grouping_id"), *merged
    )


def sum_product(df: DataFrame, a: str, b: str, key: str, name: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(F.col(a) * F.col(b)).alias(name))


def top_spenders(df: DataFrame, client: str, amount: str, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Clients by money going out, largest first: the sum of their negative amounts, and its rank."""
    spent = df.filter(F.col(amount) < 0).groupBy(client).agg(F.sum(amount).alias("spent"))
    return rank_rows(spent, "spent", False, "rank", max_group_rows)


def mean_group_count(df: DataFrame, key: str, name: str = "mean_count") -> DataFrame:
    """Mean number of rows per key."""
    return count_by(df, [key], "_n").agg(F.avg("_n").alias(name))


# Accumulator words of document queries.
_ACCUMULATE = {"$sum": F.sum, "$min": F.min, "$max": F.max, "$avg": F.avg}


def group_doc(df: DataFrame, key: str | None, accumulators: dict[str, dict]) -> DataFrame:
    """Document ``$group``: ``{"count": {"$sum": 1}, "oldest": {"$max": "age"}}``.

    A key of ``None`` makes one group of all; else the key comes out as ``_id``, nulls grouped too.
    """
    aggregates = []
    for name, wanted in accumulators.items():
        (word, arg), = wanted.items()
        column = F.col(arg) if isinstance(arg, str) else F.lit(arg)
        aggregates.append(_ACCUMULATE[word](column).alias(name))
    return df.agg(*aggregates) if key is None else df.groupBy(F.col(key).alias("_id")).agg(*aggregates)


def count_all(df: DataFrame, name: str) -> DataFrame:
    """Document ``$count``."""
    return df.agg(F.count("*").alias(name))


def count_per_year(df: DataFrame, ts: str, name: str = "n") -> DataFrame:
    return df.groupBy(F.year(ts).alias("year")).agg(F.count("*").alias(name)).orderBy("year")


def span(df: DataFrame, entity: str, ts: str, name: str = "span_sec") -> DataFrame:
    """First and last time of each entity and the seconds between."""
    ends = df.groupBy(entity).agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    return ends.withColumn(name, seconds_between("first", "last"))


def mean_span(df: DataFrame, entity: str, ts: str, name: str = "mean_span_sec") -> DataFrame:
    return span(df, entity, ts, "_span").agg(F.avg("_span").alias(name))


def compare_segments(df: DataFrame, column: str, values: list, metrics: list[str]) -> DataFrame:
    """Means of several fixed-point metrics side by side for the chosen segments."""
    means = [mean_money(m).alias(f"mean_{m}") for m in metrics]
    return df.filter(F.col(column).isin(list(values))).groupBy(column).agg(*means)


def load_by_weekday(trips: DataFrame, ts: str, boarded: str, seats: str, digits: int = 3) -> DataFrame:
    """Mean share of seats taken, by day of the week."""
    share = F.col(boarded).cast("double") / F.col(seats).cast("double")
    return trips.groupBy(weekday_name(ts).alias("weekday")).agg(F.round(F.avg(share), digits).alias("avg_load"))


def popularity(
    items: DataFrame, products: DataFrame, product: str = "product_id", name: str = "product_name",
    order: str = "order_id", quantity: str = "quantity", price: str = "price", one_row_per_order: bool = False,
) -> DataFrame:
    """Units, revenue, orders and mean price of every product that was sold.

    Items are summed by product before names are joined, so the join sees one row per product. An
    order counts once for a product, so they are first summed by (product, order): the one shuffle of
    many rows, which the count of orders needs anyway. ``one_row_per_order`` says that an order names
    a product once; then even that is not needed.
    """
    qty, cost = F.col(quantity), F.col(price)
    sums = {
        "_qty": F.sum(qty).cast("long"), "_revenue": F.sum(qty * cost).cast("decimal(24,2)"),
        "_cost": F.sum(cost).cast("decimal(24,2)"), "_prices": F.count(cost),
    }
    keys = [product] if one_row_per_order else [product, order]
    sold = items.groupBy(*keys).agg(*[s.alias(n) for n, s in sums.items()], F.count(order).alias("_orders"))
    if not one_row_per_order:
        sold = sold.groupBy(product).agg(
            F.sum("_qty").alias("_qty"), F.sum("_revenue").cast("decimal(24,2)").alias("_revenue"),
            F.sum("_cost").cast("decimal(24,2)").alias("_cost"), F.sum("_prices").alias("_prices"), F.count(order).alias("_orders"),
        )
    sold = sold.select(
        product, F.col("_qty").alias("total_quantity_sold"), F.col("_revenue").alias("total_revenue"),
        F.col("_orders").alias("order_count"), F.round(F.col("_cost") / F.col("_prices"), 2).cast("decimal(18,2)").alias("avg_price"),
    )
    columns = ["total_quantity_sold", "total_revenue", "order_count", "avg_price"]
    return products.select(product, name).join(sold, product).select(product, name, *columns)


def customer_totals(users: DataFrame, orders: DataFrame, key: str, name: str, amount: str) -> DataFrame:
    """Order sum of every user, 0 for those without orders."""
    sums = orders.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(amount).alias("total_order_sum"))
    return left_default(users.select(key, name), sums, key, {"total_order_sum": 0})


def session_summary(stats: DataFrame) -> DataFrame:
    """Mean duration and mean event count over all sessions."""
    return stats.agg(
        F.avg("duration_sec").alias("avg_duration_sec"), F.avg("event_count").alias("avg_event_count")
    )


def route_price(
    trips: DataFrame, amount: str, places: DataFrame, place_key: str, city: str, start: str, end: str
) -> DataFrame:
    """Mean fixed-point price between each pair of places.

    Trips are summed by the two keys first; the places join a row per route, not per trip.
    """
    sums = trips.groupBy(start, end).agg(F.sum(amount).alias("_sum"), F.count(amount).alias("_n"))
    named = join_roles(sums, places, {"from": start, "to": end}, place_key, [city])
    mean = F.round(F.sum("_sum") / F.sum("_n"), 0)
    return named.groupBy(f"from_{city}", f"to_{city}").agg(mean.alias("mean_price"), F.sum("_n").alias("n"))


def count_values(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """All rows beside the rows where ``column`` has a value."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count(column).alias("n_values"))


def above_mean(df: DataFrame, column: str) -> DataFrame:
    """Rows above the mean of all rows."""
    return df.filter(F.col(column) > df.agg(F.avg(column)).scalar())
