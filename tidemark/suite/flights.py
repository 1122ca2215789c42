"""Flight queries on the given tables.

flights = orders, aircrafts = customers (or parts), ticket_flights = lines, bookings = orders or events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import flights as q
from tidemark.suite.registry import Tables, money, register
from tidemark.suite.rental import renamed

# The tags, here on the statuses of the orders.
TAGS = {"P": "Planned", "F": "Already completed"}


def flights(t: Tables):
    return renamed(
        t.orders,
        flight_id="o_orderkey",
        flight_no="o_custkey",
        status="o_orderstatus",
        departure_airport="o_orderstatus",
        arrival_airport="o_orderpriority",
        aircraft_code="o_custkey",
        scheduled_departure="o_orderdate",
    )


def departures(t: Tables):
    """Flights with the first shipment as departure; NULL for an order without lines."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("flight_id"))
    first = lines.agg(F.min("l_shipdate").alias("actual_departure"))
    return flights(t).join(first, "flight_id", "left")


def models(t: Tables):
    return renamed(t.part, aircraft_code="p_partkey", model="p_name", range="p_retailprice")


def operators(t: Tables):
    return renamed(t.customer, aircraft_code="c_custkey", model="c_mktsegment", range="c_acctbal")


def tickets(t: Tables):
    return renamed(t.lineitem, ticket_no="l_partkey", flight_id="l_orderkey", fare_conditions="l_returnflag")


def bookings(t: Tables):
    return renamed(t.orders, book_ref="o_orderkey", book_date="o_orderdate", total_amount=money("o_totalprice"))


def event_bookings(t: Tables):
    return renamed(t.events, book_ref="event_id", book_date="ts", total_amount=money("value"))


FLIGHT_SQL = """o_orderkey AS flight_id, o_custkey AS flight_no, o_orderstatus AS status,
    o_orderstatus AS departure_airport, o_orderpriority AS arrival_airport, o_custkey AS aircraft_code,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS scheduled_departure"""
MODEL_SQL = "SELECT p_partkey AS aircraft_code, p_name AS model, p_retailprice AS range FROM part"


@register("l01_statuses", "SELECT o_orderstatus AS status FROM orders")
def _(t):
    return q.statuses(flights(t))


@register("l02_distinct_statuses", "SELECT DISTINCT o_orderstatus AS status FROM orders")
def _(t):
    return q.distinct_statuses(flights(t))


@register("l03_aircraft_scan", MODEL_SQL)
def _(t):
    return models(t)


@register("l04_models_by_range", "SELECT p_name AS model, p_retailprice AS range FROM part ORDER BY 2 DESC, p_partkey")
def _(t):
    return q.models_by_range(models(t))


@register("l05_flights_with_status", f"SELECT {FLIGHT_SQL} FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return q.flights_with_status(flights(t), "F")


@register("l06_flights_into", f"""
    SELECT {FLIGHT_SQL} FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def _(t):
    return q.flights_into(flights(t), "F", "1-URGENT")


@register("l07_models_starting_with", f"{MODEL_SQL} WHERE p_name LIKE 'b%'")
def _(t):
    return q.models_starting_with(models(t), "b")


@register("l08_models_containing", f"{MODEL_SQL} WHERE p_name LIKE '% r%'")
def _(t):
    return q.models_containing(models(t), " r")


@register("l09_not_departed", """
    SELECT o_orderkey AS flight_id, o_orderstatus AS status FROM orders LEFT JOIN (
        SELECT l_orderkey, min(l_shipdate) AS d FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    WHERE d IS NULL""")
def _(t):
    return q.not_departed(departures(t)).select("flight_id", "status")


@register("l10_flights_either", f"SELECT {FLIGHT_SQL} FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus = 'P'")
def _(t):
    return q.flights_either(flights(t), "F", "P")


@register("l10_flights_among", f"SELECT {FLIGHT_SQL} FROM orders WHERE o_orderstatus IN ('F', 'P')")
def _(t):
    return q.flights_among(flights(t), ("F", "P"))


PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"


def mean_sql(amount: str) -> str:
    """Rounded mean, in whole cents, of positive amounts: exact in decimals over the known ones."""
    known = f"CAST({amount} AS DECIMAL(18,2))"
    units = f"CAST(sum({known}) * 100 AS HUGEINT)"
    return f"CAST((2 * {units} + count({amount})) // (2 * count({amount})) AS BIGINT)"


@register("l11_booking_count", "SELECT count(*) AS n FROM orders")
def _(t):
    return q.booking_count(bookings(t))


@register("l12_booking_minimum", "SELECT min(o_totalprice) AS min_amount FROM orders")
def _(t):
    return q.booking_minimum(bookings(t))


@register("l13_booking_sum", f"SELECT CAST(sum({PRICE}) AS DOUBLE) AS sum_amount FROM orders")
def _(t):
    return q.booking_sum(bookings(t))


@register("l14_booking_stats", f"""
    SELECT min(o_totalprice) AS min_amount, max(o_totalprice) AS max_amount,
           CAST(sum({PRICE}) AS DOUBLE) AS sum_amount, {mean_sql("o_totalprice")} / 100.0::DOUBLE AS avg_amount
    FROM orders""")
def _(t):
    return q.booking_stats(bookings(t))


@register("l15_bookings_on_day", "SELECT count(*) AS n FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-14'")
def _(t):
    return q.bookings_on(event_bookings(t), dt.date(2024, 1, 14))


@register("l16_bookings_per_day", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return q.bookings_per_day(event_bookings(t))


@register("l17_booking_stats_per_day", f"""
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, min(value) AS min_amount, max(value) AS max_amount,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
           {mean_sql("value")} / 100.0::DOUBLE AS avg_amount,
           ({mean_sql("value")} + 2000) / 100.0::DOUBLE AS avg_plus_20
    FROM events GROUP BY 1""")
def _(t):
    return q.booking_stats_per_day(event_bookings(t))


@register("l18_busiest_routes", """
    SELECT o_orderstatus AS departure_airport, o_orderpriority AS arrival_airport,
           count(DISTINCT o_custkey) AS flight_count
    FROM orders GROUP BY 1, 2""")
def _(t):
    return q.busiest_routes(flights(t))


@register("l19_flights_per_model", """
    SELECT c_mktsegment AS model, o_custkey AS aircraft_code, count(*) AS n
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' GROUP BY 1, 2""")
def _(t):
    return q.flights_per_model(flights(t), operators(t), "P")


@register("l20_tickets_with_flight", """
    SELECT l_partkey AS tf_ticket_no, l_orderkey AS tf_flight_id, l_returnflag AS tf_fare_conditions,
           o_orderkey AS f_flight_id, o_custkey AS f_flight_no, o_orderstatus AS f_status,
           o_orderstatus AS f_departure_airport, o_orderpriority AS f_arrival_airport,
           o_custkey AS f_aircraft_code,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS f_scheduled_departure,
           c_custkey AS a_aircraft_code, c_mktsegment AS a_model, c_acctbal AS a_range
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""")
def _(t):
    return q.tickets_with_flight(tickets(t), flights(t), operators(t))


def ticket_sql(where: str, *more: str) -> str:
    columns = "".join(f", {column}" for column in more)
    return f"""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, c_mktsegment AS model, l_returnflag AS fare_conditions,
           count(DISTINCT l_partkey) AS ticket_count{columns}
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    WHERE {where} GROUP BY ALL"""


UNION_SQL = " UNION ".join(ticket_sql(f"o_orderstatus = '{s}'", f"'{tag}' AS st") for s, tag in TAGS.items())


@register("l21_tickets_per_day", ticket_sql("o_orderstatus = 'P'"))
def _(t):
    return q.tickets_per_day(tickets(t), flights(t), operators(t), "P")


@register("l22_tickets_per_day_tagged", UNION_SQL)
def _(t):
    return q.tickets_per_day_tagged(tickets(t), flights(t), operators(t), TAGS)


@register("l22_tickets_per_day_union", UNION_SQL)
def _(t):
    return q.tickets_per_day_union(tickets(t), flights(t), operators(t), TAGS)


@register("l25_tickets_per_day_and_status", ticket_sql("o_orderstatus IN ('F', 'P')", "o_orderstatus AS status"))
def _(t):
    return q.tickets_per_day_and_status(tickets(t), flights(t), operators(t), ("F", "P"))


@register("l26_largest_amount", "SELECT max(o_totalprice) AS max_amount FROM orders")
def _(t):
    return q.largest_amount(bookings(t))


BOOKING_SQL = """SELECT o_orderkey AS book_ref, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS book_date,
    o_totalprice AS total_amount FROM orders"""


@register("l27_bookings_with_largest_amount", f"""
    {BOOKING_SQL} WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)""")
def _(t):
    return q.bookings_with_largest_amount(bookings(t))


@register("l28_largest_booking", f"{BOOKING_SQL} ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 1")
def _(t):
    return q.largest_booking(bookings(t), tie="book_ref")


@register("l29_tickets_keeping_unmatched", """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, c_mktsegment AS model, l_returnflag AS fare_conditions,
           o_orderstatus AS status, count(DISTINCT l_partkey) AS ticket_count
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def _(t):
    return q.tickets_per_day_keeping_unmatched(tickets(t), flights(t), operators(t), "P")
