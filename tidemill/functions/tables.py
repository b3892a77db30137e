"""Parameterised queries that return a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions.scalar import mean_money, round_int, seconds_between, whole_div
from tidemill.operators.shape import with_params
from tidemill.sources.sinks import write_csv


def delay_statistics(
    trips: DataFrame, id: str, place: str, code, planned_start: str, actual_start: str,
    planned_end: str, actual_end: str,
) -> DataFrame:
    """Size of the start and end delay, in whole seconds, of the trips leaving one place."""

    def delay(planned: str, actual: str):
        return round_int(F.abs(seconds_between(actual, planned)))

    return trips.filter(F.col(place) == F.lit(code)).select(
        id,
        delay(planned_start, actual_start).alias("departure_delay_sec"),
        delay(planned_end, actual_end).alias("arrival_delay_sec"),
    )


def fill_shares(trips: DataFrame, tickets: DataFrame, id: str, columns: list[str] = ()) -> DataFrame:
    """Every trip's ticket count in percent of the rounded mean count, a whole number, cut off."""
    sold = tickets.groupBy(id).agg(F.count("*").alias("_sold")).join(trips.select(id, *columns), id)
    mean = sold.agg(round_int(F.avg("_sold")).alias("_mean")).scalar()
    return sold.select(id, *columns, whole_div(F.col("_sold") * 100, mean).alias("fill_percentage"))


def fill_percentage(trips: DataFrame, tickets: DataFrame, id: str, percentage: int) -> DataFrame:
    """Trips whose ticket count is at least ``percentage`` percent of the rounded mean count.

    The share is a whole number, cut off, as integer division gives.
    """
    return fill_shares(trips, tickets, id).filter(F.col("fill_percentage") >= percentage)


def export_route(
    trips: DataFrame, city_from: str, city_to: str, columns: list[str], amount: str, path: str | None = None,
) -> DataFrame:
    """Timetable between two cities with the mean ticket price, also as CSV when a path is given.

    ``trips`` has a row per ticket with the columns ``from_city`` and ``to_city``.
    """
    wanted = trips.filter((F.col("from_city") == city_from) & (F.col("to_city") == city_to))
    table = wanted.groupBy(*columns).agg(mean_money(amount).alias("avg_amount"))
    table = with_params(table, city_departure=city_from, city_arrival=city_to)
    table = table.select("city_departure", "city_arrival", *columns, "avg_amount")
    if path:
        write_csv(table, path)
    return table


# The table functions as SQL, for sessions that prefer to call them by name. Their arguments are compared by equality
# first, so a call with many of them, by LATERAL, is planned as one hash join.
DELAY_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(code {code_type})
RETURNS TABLE (trip_id BIGINT, departure_delay_sec BIGINT, arrival_delay_sec BIGINT)
RETURN SELECT t.{id},
              CAST(round(abs(timestampdiff(SECOND, t.{actual_start}, t.{planned_start}))) AS BIGINT),
              CAST(round(abs(timestampdiff(SECOND, t.{actual_end}, t.{planned_end}))) AS BIGINT)
       FROM {trips} t WHERE t.{place} = {name}.code
"""
FILL_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(code {code_type}, least BIGINT)
RETURNS TABLE (trip_id BIGINT, fill_percentage BIGINT)
RETURN SELECT s.{id}, s.fill_percentage FROM {shares} s WHERE s.{place} = {name}.code AND s.fill_percentage >= {name}.least
"""


def create_delay_function(spark, name: str, **columns: str) -> None:
    """Registers ``SELECT * FROM name(code)`` over a view or table of trips."""
    spark.sql(DELAY_FUNCTION.format(name=name, **columns))


def create_fill_function(spark, name: str, **columns: str) -> None:
    """Registers ``SELECT * FROM name(code, least)`` over a view or table of ``fill_shares`` with their place."""
    spark.sql(FILL_FUNCTION.format(name=name, **columns))


def for_each(arguments: DataFrame, name: str, *columns: str) -> DataFrame:
    """A registered table function called with every row of ``arguments``, in one plan: their columns and the result's."""
    given = ", ".join(f"a.`{c}`" for c in columns)
    return arguments.sparkSession.sql(f"SELECT * FROM {{arguments}} a, LATERAL {name}({given})", arguments=arguments)
