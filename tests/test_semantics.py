"""Small literal cases for the places where engines disagree."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.functions import scalar as S, tables as U
from tidemill.jobs.session_stats import session_stats
from tidemill.operators import aggregates as A, changes as C, joins as J, modelling as M, ordering as O
from tidemill.operators import quality as V, shape as P
from tidemill.sources import files as R


def test_lowest_edge_lies_in_no_bin(spark, rows_of):
    ages = spark.createDataFrame([(18,), (19,), (25,), (26,), (65,), (66,), (None,)], "age int")
    args = ("age", [18, 25, 35, 50, 65], ["18-25", "26-35", "36-50", "51+"])
    assert rows_of(P.bin_column(ages, *args)) == sorted(
        [(18, None), (19, "18-25"), (25, "18-25"), (26, "26-35"), (65, "51+"), (66, None), (None, None)], key=repr
    )
    assert (18, "18-25") in rows_of(P.bin_column(ages, *args, include_lowest=True))


def test_empty_bins_can_be_kept(spark):
    ages = spark.createDataFrame([(20,), (21,)], "age int")
    binned = P.bin_column(ages, "age", [18, 25, 35], ["young", "older"])
    kept = A.with_empty_bins(A.value_counts(binned, ["bin"]), ["young", "older"], "bin", {"n": 0})
    assert [tuple(r) for r in kept.select("bin", "n").collect()] == [("young", 2), ("older", 0)]


def test_last_day_is_valid_but_not_as_text(spark):
    codes = spark.createDataFrame([("2025-06-01", "2025-08-31")], "a string, b string")
    now = "2025-08-31 10:00:00"
    assert P.validity_state(codes, "a", "b", now).first()["state"] == "active"
    assert P.validity_state(codes, "a", "b", now, text_compare=True).first()["state"] == "expired"
    assert P.validity_state(codes, "a", "b", "2025-05-31").first()["state"] == "not started"


def test_delay_sign(spark):
    trip = spark.createDataFrame([("2024-01-01 10:00:00", "2024-01-01 10:01:30")], "plan string, real string")
    trip = trip.select(F.to_timestamp("plan").alias("plan"), F.to_timestamp("real").alias("real"))
    assert trip.select(S.seconds_between("real", "plan")).first()[0] == -90.0
    found = U.delay_statistics(
        trip.withColumns({"id": F.lit(1), "place": F.lit("MJZ")}), "id", "place", "MJZ", "plan", "real", "plan", "real"
    )
    assert tuple(found.first()) == (1, 90, 90)


def test_whole_numbers_round_and_divide(spark):
    row = spark.range(1).select(
        S.round_int(F.lit(2.7)), S.round_int(F.lit(2.5)), S.round_int(F.lit(-2.5)), S.whole_div(F.lit(700), F.lit(300))
    )
    assert tuple(row.first()) == (3, 3, -3, 2)


def test_fill_percentage_uses_the_rounded_mean(spark, rows_of):
    trips = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    tickets = spark.createDataFrame([(1,)] * 5 + [(2,)] * 2 + [(3,)], "id int")
    assert rows_of(U.fill_percentage(trips, tickets, "id", 50)) == [(1, 166), (2, 66)]


def test_null_order(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [r.x for r in O.sort_by(rows, "x").collect()] == [1, 2, None]
    assert [(r.x, r["rank"]) for r in O.rank_rows(rows, "x").orderBy("rank").collect()] == [(None, 1), (2, 2), (1, 3)]


def test_arrays_keep_nulls_when_asked(spark):
    rows = spark.createDataFrame([("a", 2), ("a", None), ("a", 1)], "k string, v int")
    assert O.ordered_array(rows, ["k"], "v").first()["items"] == [1, 2, None]
    assert O.ordered_array(rows, ["k"], "v", keep_nulls=False).first()["items"] == [1, 2]
    assert O.string_list(rows, ["k"], "v", sep=", ").first()["items"] == "1, 2"


def test_epoch(spark):
    row = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:01.5' AS a, TIMESTAMP_NTZ '2024-01-01 00:00:01.5' AS b")
    assert tuple(row.select(S.epoch_seconds("a"), S.epoch_seconds("b")).first()) == (1704067201.5, 1704067201.5)


def test_weekday_has_no_padding(spark):
    assert spark.range(1).select(S.weekday_name(F.lit(dt.datetime(2024, 1, 1)))).first()[0] == "monday"


def test_parsing(spark):
    texts = spark.createDataFrame([("2024-01-01",), ("soon",)], "t string")
    assert [r[0] is None for r in texts.select(S.parse_or_null("t")).collect()] == [False, True]
    with pytest.raises(Exception):
        texts.select(S.parse_or_fail("t")).collect()


def test_last_of_repeated_keys_wins(spark, rows_of):
    target = spark.createDataFrame([(4, 17, 1), (5, 1, 1)], "o int, p int, q int")
    new = spark.createDataFrame([(4, 17, 2, "f1", 0), (4, 17, 3, "f1", 9), (6, 1, 4, "f0", 3)],
                                "o int, p int, q int, f string, n int")
    once = C.upsert(target, new, ["o", "p"], ["f", "n"])
    assert rows_of(once) == [(4, 17, 3), (5, 1, 1), (6, 1, 4)]
    assert rows_of(C.upsert(once, new, ["o", "p"], ["f", "n"])) == rows_of(once)


def test_insert_ignore_keeps_known_rows(spark, rows_of):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    assert rows_of(C.insert_ignore(target, new, ["k"])) == [(1, "old"), (2, "a")]


def test_batch_update_reports_unknown_ids(spark, rows_of):
    flights = spark.createDataFrame([(1, "On Time"), (2, "On Time"), (3, None)], "id int, status string")
    updates = spark.createDataFrame([(1, "Late", 1), (1, "Cancelled", 2), (3, None, 1), (9, "Late", 1)],
                                    "id int, status string, step int")
    changed, report = C.batch_update(flights, updates, "id", "status", ["step"])
    assert rows_of(changed) == [(1, "Cancelled"), (2, "On Time"), (3, None)]
    assert rows_of(report) == [(1, True), (3, True), (9, False)]
    assert tuple(C.update_counts(report).first()) == (2, 1)


def test_delete_keeps_rows_with_unknown_condition(spark, rows_of):
    users = spark.createDataFrame([(1, 30), (2, None), (3, 20)], "id int, age int")
    assert rows_of(C.delete_where(users, F.col("age") > 25), "id") == [(2,), (3,)]


def test_replace_adds_an_absent_row(spark, rows_of):
    users = spark.createDataFrame([(1, "Alice"), (2, "Bob")], "id int, name string")
    again = spark.createDataFrame([(1, "Alicia"), (3, "Carl")], "id int, name string")
    assert rows_of(C.replace_by_key(users, again, ["id"])) == [(1, "Alicia"), (2, "Bob"), (3, "Carl")]


def test_key_dedup_breaks_ties_by_order(spark, rows_of):
    rows = spark.createDataFrame([(1, "b", 2), (1, "a", 1)], "id int, name string, seen int")
    assert rows_of(P.dedup_keys(rows, ["id"], ["seen"])) == [(1, "a", 1)]
    assert rows_of(P.last_per_key(rows, ["id"], ["seen"])) == [(1, "b", 2)]


def test_document_filters_skip_missing_fields(spark, rows_of):
    users = spark.createDataFrame([("a", 31, "Japan"), ("b", None, "Japan"), ("c", 45, None)],
                                  "name string, age int, country string")
    between = {"$and": [{"age": {"$gt": 30}}, {"age": {"$lt": 45}}]}
    assert rows_of(P.match(users, between), "name") == [("a",)]
    assert rows_of(P.match(users, {"country": "Japan", "age": {"$gte": 0}}), "name") == [("a",)]
    grouped = A.group_doc(users, "country", {"count": {"$sum": 1}})
    assert {r["_id"]: r["count"] for r in grouped.collect()} == {"Japan": 2, None: 1}


def test_suspicious_amounts_by_sign_or_size(spark, rows_of):
    rows = spark.createDataFrame([(1, 100.0, 60.0), (2, 100.0, -60.0)], "id int, balance double, amount double")
    assert rows_of(P.over_threshold(rows, "amount", "balance", 50), "id") == [(1,)]
    assert rows_of(P.over_threshold(rows, "amount", "balance", 50, use_abs=True), "id") == [(1,), (2,)]


def test_extreme_rows_with_and_without_ties(spark, rows_of):
    films = spark.createDataFrame([("b", 1990), ("a", 1990), ("c", 2000)], "title string, released int")
    assert rows_of(O.rows_at_extreme(films, "released", "min"), "title") == [("a",), ("b",)]
    assert rows_of(O.rows_at_extreme(films, "released", "min", ["title"]), "title") == [("a",)]


def test_full_name_is_null_when_a_part_is(spark, rows_of):
    people = spark.createDataFrame([("Ann", "Lee"), ("Bo", None)], "f string, l string")
    assert rows_of(P.full_name(people, "f", "l"), "full_name") == [("Ann Lee",), (None,)]


def test_sales_lines(spark, rows_of):
    lines = spark.createDataFrame([("Бананы,3шт,100р",), ("Сыр,x,5р",), ("Чай",)], "value string")
    assert rows_of(R.parse_sales_lines(lines)) == [("Бананы", 3, 100), ("Сыр", None, 5), ("Чай", None, None)]


def test_cells_with_several_values(spark, rows_of):
    clients = spark.createDataFrame([("Ivan", "1, 2,3")], "client string, phone string")
    assert rows_of(P.explode_cell(clients, "phone")) == [("Ivan", "1"), ("Ivan", "2"), ("Ivan", "3")]


def test_sessions_last_row_wins_and_events_count_once(spark, rows_of):
    sessions = spark.createDataFrame([("s1", 5, 1), ("s1", 9, 2), ("s2", 0, 1), ("s3", 4, 1)],
                                     "session_id string, duration_sec int, at int")
    events = spark.createDataFrame([(1, "s1"), (1, "s1"), (2, "s1"), (3, "s2"), (4, "other")],
                                   "event_id int, session_id string")
    assert rows_of(session_stats(sessions, events, ["at"])) == [("s1", 9, 2)]
    assert rows_of(session_stats(sessions, events, ["at"], event_id=None)) == [("s1", 9, 3)]


def test_rules_report_every_failure(spark):
    items = spark.createDataFrame([("1", "2", "3", "4.5"), ("0", "x", None, "-1")],
                                  "order_id string, product_id string, quantity string, price string")
    bad = V.validate(items, V.rules_for("order_items")).collect()
    assert len(bad) == 1 and len(bad[0]["errors"]) == 4
    good, rest = V.split_valid(items, V.rules_for("order_items"))
    assert (good.count(), rest.count()) == (1, 1)
    with pytest.raises(ValueError):
        V.rules_for("unknown")
    with pytest.raises(ValueError):
        V.check_not_empty(items.filter("false"))


def test_constraints(spark):
    codes = spark.createDataFrame(
        [("A", 10, "x", "y", 1), ("A", 0, "x", "y", 2), ("B", 101, None, "y", None)],
        "code string, discount_percent int, valid_from string, valid_to string, is_active int",
    )
    report = {r["rule"]: r["n_broken"] for r in V.check_constraints(codes, V.rules_for("promocodes"), [["code"]]).collect()}
    assert report["discount_percent must be from 1 to 100"] == 2
    assert report["is_active must be one of 0, 1"] == 1
    assert report["valid_from is required"] == 1
    assert report["code must be unique"] == 1


def test_course_constraints(spark):
    reviews = spark.createDataFrame([(1, 1, 5), (1, 1, 4), (2, 1, 6), (2, 2, None)], "student_id int, course_id int, rating int")
    report = V.check_constraints(reviews, V.rules_for("course_reviews"), [["student_id", "course_id"]])
    assert {r["rule"]: r["n_broken"] for r in report.collect()} == {
        "rating is required": 1, "rating must be from 1 to 5": 1, "student_id, course_id must be unique": 1,
    }
    enrolled = spark.createDataFrame([("active", None), ("gone", "paid"), ("paused", "free")], "status string, payment_status string")
    assert V.validate(enrolled, V.rules_for("students_courses")).count() == 2


def test_top_spenders(spark, rows_of):
    moves = spark.createDataFrame([("a", -5), ("a", 100), ("a", -1), ("b", -9), ("c", 3)], "client string, amount int")
    assert rows_of(A.top_spenders(moves, "client", "amount")) == [("a", -6, 2), ("b", -9, 1)]


def test_normal_forms(spark, rows_of):
    staff = spark.createDataFrame([(1, "IT", "Oleg"), (2, "IT", "Oleg"), (3, "HR", "Anna")],
                                  "id int, department string, head string")
    assert M.check_fd(staff, ["department"], ["head"]).isEmpty()
    assert rows_of(M.check_fd(staff, ["head"], ["id"])) == [("Oleg", 2)]
    rest, tables = M.decompose(staff, {"departments": (["department"], ["head"])})
    assert rows_of(tables["departments"]) == [("HR", "Anna"), ("IT", "Oleg")]
    assert rows_of(rest.join(tables["departments"], "department").select("id", "department", "head")) == rows_of(staff)


def test_surrogate_keys_stay_on_a_rerun(spark, rows_of):
    raw = spark.createDataFrame([("tea",), ("milk",), ("tea",), (None,)], "product string")
    known = spark.createDataFrame([(7, "milk")], "product_id long, product_name string")
    dim = M.Dimension(known, {"product": "product_name"}, "product_id")
    first = M.members(raw, dim)
    assert rows_of(first) == [(7, "milk"), (8, "tea")]
    again = M.Dimension(first, {"product": "product_name"}, "product_id")
    assert rows_of(M.members(raw, again)) == rows_of(first)
    _, fact = M.normalise(raw, {"products": dim}, ["product", "product_id"])
    assert rows_of(fact) == sorted([("tea", 8), ("milk", 7), ("tea", 8), (None, None)], key=repr)


def test_scalar_columns_do_not_change_rows(spark, rows_of):
    rows = spark.createDataFrame([(1,), (2,)], "x int")
    assert rows_of(J.with_scalar(rows, rows.agg(F.max("x").alias("m")))) == [(1, 2), (2, 2)]


def test_orphans_ignore_null_keys(spark, rows_of):
    child = spark.createDataFrame([(1, 1), (2, 5), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(1,)], "pk int")
    assert rows_of(J.orphans(child, parent, ["fk"], ["pk"]), "id") == [(2,)]


def test_popularity_of_the_last_quantities(spark, rows_of):
    items = spark.createDataFrame([(1, 10, 2, Decimal("1.10")), (1, 11, 1, Decimal("5.00")), (2, 10, 1, Decimal("1.25"))],
                                  "order_id int, product_id int, quantity int, price decimal(10,2)")
    products = spark.createDataFrame([(10, "tea"), (11, "milk"), (12, "unsold")], "product_id int, product_name string")
    assert rows_of(A.popularity(items, products)) == [
        (10, "tea", 3, Decimal("3.45"), 2, Decimal("1.18")), (11, "milk", 1, Decimal("5.00"), 1, Decimal("5.00"))
    ]
