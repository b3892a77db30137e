"""Reports over an airline schema with its own column names, each beside plain SQL on the same rows."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.oracle_check import ordered
from tidemill.functions import scalar as S, tables as U
from tidemill.operators import aggregates as A, changes as C, joins as J, ordering as O, shape as P

SCHEMAS = {
    "airports": "airport_code string, airport_name string, city string",
    "aircrafts": "aircraft_code string, model string",
    "seats": "aircraft_code string, seat_no string, fare_conditions string",
    "flights": (
        "flight_id int, flight_no string, departure_airport string, arrival_airport string, aircraft_code string, "
        "status string, scheduled_departure timestamp_ntz, actual_departure timestamp_ntz, "
        "scheduled_arrival timestamp_ntz, actual_arrival timestamp_ntz"
    ),
    "ticket_flights": "ticket_no string, flight_id int, fare_conditions string, amount decimal(10,2)",
    "tickets": "ticket_no string, book_ref string, passenger_id string, passenger_name string",
    "bookings": "book_ref string, book_date timestamp_ntz, total_amount decimal(10,2)",
    "boarding_passes": "ticket_no string, flight_id int, boarding_no int, seat_no string",
}


def made_rows():
    rng = random.Random(7)
    airports = [(c, f"Port {c}", city) for c, city in [("SVO", "Moscow"), ("VKO", "Moscow"), ("LED", "Petersburg"), ("KZN", "Kazan")]]
    aircrafts = [("773", "Large"), ("SU9", "Small")]
    seats = [(a, f"{n}{letter}", "Business" if n < 3 else "Comfort" if n < 4 and a == "773" else "Economy")
             for a, _ in aircrafts for n in range(1, 6) for letter in "ABC"]
    start, flights = dt.datetime(2017, 8, 28), []
    for i in range(60):
        leave = start + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 7, 5))
        delay = rng.choice([None, 0, 0, 3, 90])
        land = leave + dt.timedelta(minutes=rng.randrange(60, 200))
        later = None if delay is None else dt.timedelta(minutes=delay)
        a, b = rng.sample([x[0] for x in airports], 2)
        flights.append((i, f"PG{i % 20:04d}", a, b, rng.choice(["773", "SU9"]), "Scheduled", leave,
                        None if later is None else leave + later, land, None if later is None else land + later))
    bookings = [(f"B{i:03d}", start + dt.timedelta(hours=rng.randrange(24 * 90)), rng.randrange(1000, 90000) / 1) for i in range(80)]
    tickets = [(f"T{i:04d}", f"B{rng.randrange(80):03d}", f"{rng.randrange(9999):04d}", f"NAME {rng.randrange(40)}") for i in range(200)]
    legs = sorted({(t[0], rng.randrange(60)) for t in tickets for _ in range(rng.randrange(1, 4))})
    prices = [(t, f, rng.choice(["Economy", "Business"]), rng.randrange(300000, 2000000) / 100) for t, f in legs]
    passes = [(t, f, n + 1, rng.choice(seats)[1]) for n, (t, f) in enumerate(legs) if n % 5]
    return dict(airports=airports, aircrafts=aircrafts, seats=seats, flights=flights, ticket_flights=prices,
                tickets=tickets, bookings=bookings, boarding_passes=passes)


@pytest.fixture(scope="module")
def air(spark):
    """The frames, and a connection that holds the same rows."""
    con, frames = duckdb.connect(), {}
    for name, rows in made_rows().items():
        ddl = SCHEMAS[name].replace("timestamp_ntz", "timestamp").replace(" string", " varchar")
        con.execute(f"CREATE TABLE {name} ({ddl})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
        loose = SCHEMAS[name].replace("decimal(10,2)", "double")
        frame = spark.createDataFrame(rows, loose)
        if "decimal" in SCHEMAS[name]:
            column = "amount" if name == "ticket_flights" else "total_amount"
            frame = frame.withColumn(column, F.col(column).cast("decimal(10,2)"))
        frames[name] = frame
    return frames, con


def check(df, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    got = [tuple(r) for r in df.select(*names).collect()]

    def even(rows):
        return [tuple(round(float(v), 6) if isinstance(v, float) or v.__class__.__name__ == "Decimal" else v for v in r) for r in rows]

    assert expected and ordered(names, even(got)) == ordered(names, even(expected))


def test_seats(air):
    t, con = air
    check(A.count_by(t["seats"], ["aircraft_code"], "total"), con, "SELECT aircraft_code, count(*) AS total FROM seats GROUP BY 1")
    check(A.value_counts(t["seats"], ["fare_conditions"]), con, "SELECT fare_conditions, count(*) AS n FROM seats GROUP BY 1")
    shares = A.shares(t["seats"], "aircraft_code", "fare_conditions", {"Business": "b", "Comfort": "c", "Economy": "e"})
    check(shares, con, """
        SELECT aircraft_code, avg((fare_conditions = 'Business')::INT) * 100 AS b, avg((fare_conditions = 'Comfort')::INT) * 100 AS c,
               avg((fare_conditions = 'Economy')::INT) * 100 AS e FROM seats GROUP BY 1""")
    check(O.ordered_array(t["seats"], ["aircraft_code"], "seat_no"), con,
          "SELECT aircraft_code, list(seat_no ORDER BY seat_no) AS items FROM seats GROUP BY 1")


def test_ticket_prices(air):
    t, con = air
    check(A.spread(t["ticket_flights"], "flight_id", "amount").drop("mean"), con, """
        SELECT flight_id, min(amount) AS lowest, max(amount) AS highest, max(amount) - min(amount) AS difference
        FROM ticket_flights GROUP BY 1""")
    check(O.median_by(t["ticket_flights"], ["flight_id"], "amount"), con,
          "SELECT flight_id, quantile_cont(amount::DOUBLE, 0.5) AS median FROM ticket_flights GROUP BY 1")


def test_bookings_by_month(air):
    t, con = air
    months = A.monthly(t["bookings"], "book_date", "total_amount")
    check(months.withColumn("month", F.col("month").cast("timestamp_ntz")), con, """
        SELECT date_trunc('month', book_date)::TIMESTAMP AS month, count(*) AS n, sum(total_amount) AS total,
               sum(total_amount)::DOUBLE / count(*) AS mean FROM bookings GROUP BY 1""")
    amounts = t["bookings"].withColumn("month", S.month_start("book_date").cast("timestamp_ntz"))
    check(O.ordered_array(amounts, ["month"], "total_amount").withColumn("total", F.size("items").cast("long")), con,
          "SELECT date_trunc('month', book_date)::TIMESTAMP AS month, count(*) AS total FROM bookings GROUP BY 1")


def test_flights_by_airport(air):
    t, con = air
    check(A.distinct_by(t["flights"], "departure_airport", "arrival_airport"), con, """
        SELECT departure_airport, count(*) AS n, count(DISTINCT arrival_airport) AS n_distinct FROM flights GROUP BY 1""")
    check(O.string_list(t["flights"], ["departure_airport"], "arrival_airport"), con, """
        SELECT departure_airport, string_agg(arrival_airport, ', ' ORDER BY arrival_airport) AS items FROM flights GROUP BY 1""")
    few = A.having(t["flights"], ["departure_airport"], F.col("n") < 16)
    named = few.join(t["airports"], F.col("departure_airport") == F.col("airport_code"))
    check(named, con, """
        SELECT airport_name, count(flight_id) AS n FROM flights JOIN airports ON airport_code = departure_airport
        GROUP BY 1 HAVING n < 16""")


def test_numbering_and_neighbours(air):
    t, con = air
    order = [O.asc("scheduled_departure"), O.asc("flight_id")]
    check(O.number_rows(t["flights"], order), con,
          "SELECT flight_id, row_number() OVER (ORDER BY scheduled_departure, flight_id) AS row_number FROM flights")
    check(O.rank_rows(t["bookings"], "total_amount"), con,
          "SELECT book_ref, rank() OVER (ORDER BY total_amount DESC) AS rank FROM bookings")
    for move, word in ((O.next_value, "lead"), (O.prev_value, "lag")):
        check(move(t["flights"], ["flight_no"], order, "scheduled_departure", "other"), con, f"""
            SELECT flight_id, {word}(scheduled_departure) OVER (PARTITION BY flight_no ORDER BY scheduled_departure, flight_id) AS other
            FROM flights""")


ROUTES = """flights f JOIN ticket_flights tf ON tf.flight_id = f.flight_id
    JOIN airports a ON a.airport_code = f.departure_airport JOIN airports b ON b.airport_code = f.arrival_airport"""


def test_routes(air):
    t, con = air
    sold = t["ticket_flights"].join(t["flights"], "flight_id")
    prices = A.route_price(sold, "amount", t["airports"], "airport_code", "city", "departure_airport", "arrival_airport")
    check(prices, con, f"""
        SELECT a.city AS from_city, b.city AS to_city, round(sum(amount)::DOUBLE / count(*)) AS mean_price, count(*) AS n
        FROM {ROUTES} GROUP BY 1, 2""")
    check(prices.orderBy(F.desc("n"), "from_city", "to_city").limit(5), con, f"""
        SELECT a.city AS from_city, b.city AS to_city, count(tf.ticket_no) AS n FROM {ROUTES} GROUP BY 1, 2
        ORDER BY n DESC, 1, 2 LIMIT 5""")


def test_pairs_from_one_airport_within_an_hour(air):
    t, con = air
    for keys, equal in ((["departure_airport"], "AND a.departure_airport = b.departure_airport"), ([], "")):
        check(J.band_self_join(t["flights"], "flight_id", "scheduled_departure", 3600, keys, ordered_pairs=True), con, f"""
            SELECT a.flight_id AS a_id, b.flight_id AS b_id FROM flights a, flights b WHERE a.flight_id <> b.flight_id {equal}
              AND abs(epoch(a.scheduled_departure) - epoch(b.scheduled_departure)) <= 3600""")


def test_totals_in_every_cut(air):
    t, con = air
    facts = t["ticket_flights"].join(t["flights"], "flight_id").join(
        t["airports"], F.col("airport_code") == F.col("departure_airport")
    ).withColumn("month", S.month_start("scheduled_departure").cast("timestamp_ntz"))
    cuts = [["fare_conditions"], ["month"], ["airport_name"], ["fare_conditions", "month"],
            ["fare_conditions", "airport_name"], ["month", "airport_name"], []]
    check(A.grouping_sets(facts, ["fare_conditions", "month", "airport_name"], cuts, {"n": ("count", "*")}), con, """
        SELECT fare_conditions, month, airport_name, count(*) AS n FROM (
            SELECT tf.fare_conditions, date_trunc('month', scheduled_departure)::TIMESTAMP AS month, airport_name
            FROM flights f JOIN ticket_flights tf ON tf.flight_id = f.flight_id JOIN airports ON airport_code = departure_airport)
        GROUP BY GROUPING SETS ((fare_conditions), (month), (airport_name), (fare_conditions, month),
                                (fare_conditions, airport_name), (month, airport_name), ())""")


def test_delays(air):
    t, con = air
    flown = P.present(t["flights"], "actual_departure")
    delays = flown.select("flight_id", S.seconds_between("actual_departure", "scheduled_departure").alias("delay"))
    check(A.above_mean(delays, "delay"), con, """
        WITH d AS (SELECT flight_id, epoch(scheduled_departure) - epoch(actual_departure) AS delay FROM flights
                   WHERE actual_departure IS NOT NULL)
        SELECT flight_id, delay FROM d WHERE delay > (SELECT avg(delay) FROM d)""")
    found = U.delay_statistics(t["flights"], "flight_id", "departure_airport", "SVO", "scheduled_departure",
                               "actual_departure", "scheduled_arrival", "actual_arrival")
    check(found, con, """
        SELECT flight_id, abs(epoch(scheduled_departure) - epoch(actual_departure))::BIGINT AS departure_delay_sec,
               abs(epoch(scheduled_arrival) - epoch(actual_arrival))::BIGINT AS arrival_delay_sec
        FROM flights WHERE departure_airport = 'SVO'""")


def test_sales_by_flight(air):
    t, con = air
    sold = A.count_by(t["ticket_flights"], ["flight_id"], "sold")
    counts = "(SELECT flight_id, count(*) AS sold FROM ticket_flights GROUP BY 1)"
    check(A.above_mean(sold, "sold"), con, f"SELECT flight_id, sold FROM {counts} WHERE sold > (SELECT avg(sold) FROM {counts})")
    check(U.fill_percentage(t["flights"], t["ticket_flights"], "flight_id", 80), con, f"""
        SELECT flight_id, sold * 100 // (SELECT round(avg(sold))::BIGINT FROM {counts}) AS fill_percentage FROM {counts}
        WHERE fill_percentage >= 80""")


def test_timetable_of_a_route(air, tmp_path):
    t, con = air
    trips = t["ticket_flights"].join(t["flights"], "flight_id").join(t["aircrafts"], "aircraft_code")
    named = J.join_roles(trips, t["airports"], {"from": "departure_airport", "to": "arrival_airport"}, "airport_code", ["city"])
    columns = ["flight_no", "scheduled_departure", "scheduled_arrival", "model"]
    path = str(tmp_path / "timetable")
    check(U.export_route(named, "Moscow", "Kazan", columns, "amount", path), con, f"""
        SELECT 'Moscow' AS city_departure, 'Kazan' AS city_arrival, flight_no, scheduled_departure, scheduled_arrival, model,
               sum(amount)::DOUBLE / count(*) AS avg_amount
        FROM {ROUTES} JOIN aircrafts m ON m.aircraft_code = f.aircraft_code
        WHERE a.city = 'Moscow' AND b.city = 'Kazan' GROUP BY ALL""")
    assert t["flights"].sparkSession.read.option("header", True).csv(path).count() > 0


def test_status_updates(air, rows_of):
    t, _ = air
    spark = t["flights"].sparkSession
    updates = spark.createDataFrame([(3, "Delayed", 0), (999, "Cancelled", 1)], "flight_id int, status string, step int")
    changed, report = C.batch_update(t["flights"], updates, "flight_id", "status", ["step"])
    assert rows_of(changed.filter("status <> 'Scheduled'"), "flight_id", "status") == [(3, "Delayed")]
    assert rows_of(report) == [(3, True), (999, False)]


def test_boarding(air):
    t, con = air
    joined = J.star_join(
        t["boarding_passes"].withColumnRenamed("seat_no", "seat"),
        [
            (t["tickets"].withColumnRenamed("ticket_no", "ticket"), F.col("ticket_no") == F.col("ticket")),
            (t["seats"], F.col("seat") == F.col("seat_no")),
            (t["bookings"].withColumnRenamed("book_ref", "ref"), F.col("book_ref") == F.col("ref")),
        ],
        F.col("passenger_name").isin("NAME 1", "NAME 2") & (F.col("boarding_no") < 300), ["boarding_no", "passenger_id"],
    )
    check(joined, con, """
        SELECT boarding_no, passenger_id FROM boarding_passes bp JOIN tickets t ON bp.ticket_no = t.ticket_no
        JOIN seats s ON bp.seat_no = s.seat_no JOIN bookings b ON t.book_ref = b.book_ref
        WHERE passenger_name IN ('NAME 1', 'NAME 2') AND boarding_no < 300""")
    check(O.top_by_count(t["tickets"], ["passenger_name"], 10), con, """
        SELECT passenger_name, count(ticket_no) AS n FROM tickets GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10""")
    trips = J.join_aggregates(t["flights"], [
        (t["boarding_passes"], "flight_id", {"boarded": F.count("*")}),
        (t["seats"], "aircraft_code", {"seats": F.count("*")}),
    ])
    check(A.load_by_weekday(trips, "scheduled_departure", "boarded", "seats"), con, """
        SELECT lower(dayname(scheduled_departure)) AS weekday, round(avg(boarded / seats), 3) AS avg_load FROM flights f
        JOIN (SELECT flight_id, count(*)::DOUBLE AS boarded FROM boarding_passes GROUP BY 1) p ON p.flight_id = f.flight_id
        JOIN (SELECT aircraft_code, count(*) AS seats FROM seats GROUP BY 1) s ON s.aircraft_code = f.aircraft_code GROUP BY 1""")
