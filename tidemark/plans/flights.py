"""Flight-booking queries.

Each takes the tables it reads:

    flights(flight_id, flight_no, status, departure_airport, arrival_airport, aircraft_code,
            scheduled_departure, actual_departure)
    aircrafts(aircraft_code, model, range)
    bookings(book_date, total_amount, ...)
    ticket_flights(ticket_no, flight_id, fare_conditions)
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day, on_day
from tidemark.operators.ordering import asc, desc, sort_desc, top_n
from tidemark.operators.relational import (
    amount_stats,
    group_count,
    group_distinct,
    join_chain,
    prefixed,
    rounded_mean,
)
from tidemark.operators.setops import union_distinct

# What the queries ask for unless told otherwise, and the tags statuses are shown under.
ARRIVED = "Arrived"
SCHEDULED = "Scheduled"
STATUS_TAGS = {SCHEDULED: "Planned", ARRIVED: "Already completed"}
AIRPORT = "LED"
MODEL_PREFIX = "Boeing"
MODEL_INFIX = "R"
BOOKING_DAY = dt.date(2017, 7, 14)


def statuses(flights: DataFrame) -> DataFrame:
    return flights.select("status")


def distinct_statuses(flights: DataFrame) -> DataFrame:
    return flights.select("status").distinct()


def models_by_range(aircrafts: DataFrame) -> DataFrame:
    return sort_desc(aircrafts, "range", tie="aircraft_code").select("model", "range")


def flights_with_status(flights: DataFrame, status: str = ARRIVED) -> DataFrame:
    return flights.filter(F.col("status") == status)


def flights_into(flights: DataFrame, status: str = ARRIVED, airport: str = AIRPORT) -> DataFrame:
    return flights.filter((F.col("status") == status) & (F.col("arrival_airport") == airport))


def models_starting_with(aircrafts: DataFrame, prefix: str = MODEL_PREFIX) -> DataFrame:
    """Case-sensitive prefix; the Parquet scan takes it as a filter."""
    return aircrafts.filter(F.col("model").startswith(prefix))


def models_containing(aircrafts: DataFrame, infix: str = MODEL_INFIX) -> DataFrame:
    return aircrafts.filter(F.col("model").contains(infix))


def not_departed(flights: DataFrame) -> DataFrame:
    return flights.filter(F.col("actual_departure").isNull())


def flights_either(flights: DataFrame, first: str = ARRIVED, second: str = SCHEDULED) -> DataFrame:
    return flights.filter((F.col("status") == first) | (F.col("status") == second))


def flights_among(flights: DataFrame, wanted: tuple[str, ...] = (ARRIVED, SCHEDULED)) -> DataFrame:
    return flights.filter(F.col("status").isin(*wanted))


def booking_count(bookings: DataFrame) -> DataFrame:
    return bookings.agg(F.count(F.lit(1)).alias("n"))


def booking_minimum(bookings: DataFrame) -> DataFrame:
    return bookings.agg(F.min("total_amount").alias("min_amount"))


def booking_sum(bookings: DataFrame) -> DataFrame:
    return bookings.agg(F.sum("total_amount").alias("sum_amount"))


def booking_stats(bookings: DataFrame) -> DataFrame:
    """Minimum, maximum, sum and rounded mean in one pass."""
    return bookings.agg(*amount_stats("total_amount")[1:])


def bookings_on(bookings: DataFrame, when: dt.date = BOOKING_DAY) -> DataFrame:
    return bookings.filter(on_day("book_date", when)).agg(F.count(F.lit(1)).alias("n"))


def bookings_per_day(bookings: DataFrame) -> DataFrame:
    return sort_desc(group_count(bookings, day("book_date").alias("day")), "n", tie="day")


def booking_stats_per_day(bookings: DataFrame) -> DataFrame:
    """Count, minimum, maximum, sum, rounded mean and rounded mean plus 20, busiest day first."""
    stats = bookings.groupBy(day("book_date").alias("day")).agg(
        *amount_stats("total_amount"),
        (rounded_mean("total_amount") + 20).alias("avg_plus_20"),
    )
    return sort_desc(stats, "n", tie="day")


def busiest_routes(flights: DataFrame) -> DataFrame:
    routes = group_distinct(flights, ["departure_airport", "arrival_airport"], "flight_no", "flight_count")
    return routes.orderBy(desc("flight_count"), asc("departure_airport"), asc("arrival_airport"))


def flights_per_model(flights: DataFrame, aircrafts: DataFrame, status: str = SCHEDULED) -> DataFrame:
    """Flights of one status per model and aircraft code, counted before the join."""
    counts = group_count(flights.filter(F.col("status") == status), "aircraft_code")
    joined = counts.join(aircrafts.select("aircraft_code", "model"), "aircraft_code")
    return joined.groupBy("model", "aircraft_code").agg(F.sum("n").alias("n"))


def tickets_with_flight(ticket_flights: DataFrame, flights: DataFrame, aircrafts: DataFrame) -> DataFrame:
    """Every ticket with flight and aircraft, NULL where unknown; columns are prefixed per table."""
    tf, f, a = prefixed(ticket_flights, "tf"), prefixed(flights, "f"), prefixed(aircrafts, "a")
    return join_chain(
        tf.withColumn("flight", F.col("tf_flight_id")),
        (f.withColumn("flight", F.col("f_flight_id")).withColumn("code", F.col("f_aircraft_code")), "flight", "left"),
        (a.withColumn("code", F.col("a_aircraft_code")), "code", "left"),
    ).drop("flight", "code")


def _ticket_counts(tickets: DataFrame, *more: str | Column) -> DataFrame:
    return group_distinct(tickets, ["day", "model", "fare_conditions", *more], "ticket_no", "ticket_count")


def _tickets_of(
    ticket_flights: DataFrame, flights: DataFrame, aircrafts: DataFrame, how: str = "inner"
) -> DataFrame:
    """Tickets with the day and status of their flight, if it is among ``flights``, and its model, if known.

    The day is taken of each flight before it meets its tickets.
    """
    columns = ["flight_id", "aircraft_code", day("scheduled_departure").alias("day"), "status"]
    return join_chain(
        ticket_flights,
        (flights.select(*columns), "flight_id", how),
        (aircrafts.select("aircraft_code", "model"), "aircraft_code", "left"),
    )


def tickets_per_day(
    ticket_flights: DataFrame, flights: DataFrame, aircrafts: DataFrame, status: str = SCHEDULED
) -> DataFrame:
    """Distinct tickets per day, model and fare for one status.

    A filter on the flight's status makes a left join to the flights an inner one.
    """
    tickets = _tickets_of(ticket_flights, flights_with_status(flights, status), aircrafts)
    return _ticket_counts(tickets).orderBy(asc("day"), asc("model"), asc("fare_conditions"))


def tickets_per_day_tagged(
    ticket_flights: DataFrame,
    flights: DataFrame,
    aircrafts: DataFrame,
    tags: dict[str, str] = STATUS_TAGS,
) -> DataFrame:
    """``tickets_per_day`` of several statuses with a tag each, from one scan and one aggregate.

    The tags differ, so no two branches share a row and their union needs no pass of its own.
    """
    tickets = _tickets_of(ticket_flights, flights_among(flights, tuple(tags)), aircrafts)
    tag = F.lit(None).cast("string")
    for status, label in tags.items():
        tag = F.when(F.col("status") == status, F.lit(label)).otherwise(tag)
    # Statuses are shorter than tags, so they are grouped and the tags attached to the groups.
    counts = _ticket_counts(tickets, "status").select(
        "day", "model", "fare_conditions", "ticket_count", tag.alias("st")
    )
    return counts.orderBy(asc("day"), asc("model"), asc("fare_conditions"), asc("st"))


def tickets_per_day_union(
    ticket_flights: DataFrame,
    flights: DataFrame,
    aircrafts: DataFrame,
    tags: dict[str, str] = STATUS_TAGS,
) -> DataFrame:
    """The same rows as a distinct union of one query per status."""
    branches = [
        _ticket_counts(_tickets_of(ticket_flights, flights_with_status(flights, status), aircrafts)).withColumn(
            "st", F.lit(label)
        )
        for status, label in tags.items()
    ]
    united = branches[0]
    for branch in branches[1:]:
        united = union_distinct(united, branch)
    return united.orderBy(asc("day"), asc("model"), asc("fare_conditions"), asc("st"))


def tickets_per_day_and_status(
    ticket_flights: DataFrame,
    flights: DataFrame,
    aircrafts: DataFrame,
    wanted: tuple[str, ...] = (ARRIVED, SCHEDULED),
) -> DataFrame:
    tickets = _tickets_of(ticket_flights, flights_among(flights, wanted), aircrafts)
    counts = _ticket_counts(tickets, "status").select(
        "day", "model", "fare_conditions", "ticket_count", "status"
    )
    return counts.orderBy(asc("day"), asc("model"), asc("fare_conditions"), asc("status"))


def tickets_per_day_keeping_unmatched(
    ticket_flights: DataFrame, flights: DataFrame, aircrafts: DataFrame, status: str = SCHEDULED
) -> DataFrame:
    """Filter below the left join: tickets of other flights fall into groups with NULL keys."""
    tickets = _tickets_of(ticket_flights, flights_with_status(flights, status), aircrafts, "left")
    counts = _ticket_counts(tickets, "status")
    return counts.orderBy(asc("day"), asc("model"), asc("fare_conditions"), asc("status"))


def largest_amount(bookings: DataFrame) -> DataFrame:
    return bookings.agg(F.max("total_amount").alias("max_amount"))


def bookings_with_largest_amount(bookings: DataFrame) -> DataFrame:
    """All bookings whose amount equals the maximum."""
    return bookings.filter(F.col("total_amount") == largest_amount(bookings).scalar())


def largest_booking(bookings: DataFrame, tie: str) -> DataFrame:
    """One booking with the largest amount; an unknown amount ranks first."""
    return top_n(bookings, 1, "total_amount", tie=tie)
