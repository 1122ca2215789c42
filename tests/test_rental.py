"""H1 to H7 on hand-written rows, with the cases in which the forms of a query differ."""

import datetime as dt
from decimal import Decimal

import pytest

from tidemark.plans import rental as q


def ts(day, hour=0):
    return dt.datetime(2021, 1, 1) + dt.timedelta(days=day - 1, hours=hour)


@pytest.fixture(scope="module")
def t(spark):
    """Two categories are called Drama; film 5 has no inventory, film 6 no category."""
    def frame(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return {
        "category": frame("category_id int, name string", (1, "Drama"), (2, "Children"), (3, "Drama"), (4, "Empty")),
        "film": frame("film_id int, title string", *[(i, f"f{i}") for i in range(1, 7)]),
        "film_category": frame("film_id int, category_id int", (1, 1), (2, 1), (3, 2), (4, 3), (5, 3), (1, 2)),
        "actor": frame(
            "actor_id int, first_name string, last_name string",
            (1, "Ann", "Lee"), (2, "Ann", "Lee"), (3, "Bob", "Ray"), (4, "Cy", "Fox"),
        ),
        "film_actor": frame("actor_id int, film_id int", (1, 1), (1, 2), (2, 1), (3, 3), (4, 5)),
        "inventory": frame("inventory_id int, film_id int", (10, 1), (11, 1), (12, 2), (13, 3), (14, 4)),
        "rental": frame(
            "rental_id int, inventory_id int, customer_id int, rental_date timestamp, return_date timestamp",
            (100, 10, 1, ts(1), ts(3)),
            (101, 11, 1, ts(1), ts(2)),
            (102, 12, 2, ts(1), ts(41, 5)),
            (103, 13, 3, ts(1), None),
            (104, 14, 2, ts(1), ts(2)),
            (10, 14, 1, ts(1), ts(5)),
        ),
        "payment": frame(
            "rental_id int, amount decimal(10,2)",
            *[(i, Decimal(a)) for i, a in ((100, "1.10"), (101, "2.20"), (102, "5.00"), (104, "0.99"))],
            (103, None),
        ),
        "customer": frame("customer_id int, address_id int, active int", (1, 1, 1), (2, 2, 0), (3, 3, None), (4, 1, 2)),
        "address": frame("address_id int, city_id int", (1, 1), (2, 2), (3, 3), (4, 5)),
        "city": frame(
            "city_id int, city string", (1, "aa-b"), (2, "x-y"), (3, "Abc"), (4, "nowhere"), (5, "no customers")
        ),
    }


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_h1_equal_names_stay_apart(t):
    assert rows(q.films_per_category(t)) == [("Drama", 2), ("Children", 2), ("Drama", 2)]


def test_h2_fan_out_counts_every_rental_of_every_film(t):
    # film 1 has items 10 and 11, rented once each; film 2 once; film 3 once; film 5 never.
    assert rows(q.most_rented_actors(t)) == [("Ann", "Lee", 3), ("Ann", "Lee", 2), ("Bob", "Ray", 1)]
    assert rows(q.most_rented_actors(t, n=1)) == [("Ann", "Lee", 3)]


def test_h3_money_per_category(t):
    found = {r[0]: (r[1], None if r[2] is None else str(r[2])) for r in rows(q.money_per_category(t))}
    # Rentals 10 and 104 are of film 4; rental 103 has an unknown amount; film 1 counts in both of its categories.
    assert found == {1: ("Drama", "8.30"), 2: ("Children", "3.30"), 3: ("Drama", "0.99")}


def test_h3_unknown_sum_ranks_first(t):
    only_three = dict(t, film_category=t["film_category"].filter("film_id in (2, 3)"))
    assert rows(q.top_category_by_money(only_three)) == [("Children", None)]
    assert [(n, str(a)) for n, a in rows(q.top_category_by_money(t))] == [("Drama", "8.30")]


def test_h4_films_without_inventory(t):
    assert sorted(rows(q.films_not_in_inventory(t))) == [(5, "f5"), (6, "f6")]


def children(spark, t, *counts):
    """Actors 1, 2, ... with the given numbers of films in category Children."""
    films = [(n, 2) for n in range(1, max(counts) + 1)]
    roles = [(actor + 1, film + 1) for actor, n in enumerate(counts) for film in range(n)]
    names = [(actor + 1, f"a{actor + 1}", "x") for actor in range(len(counts))]
    return dict(
        t,
        film_category=spark.createDataFrame(films, "film_id int, category_id int"),
        film_actor=spark.createDataFrame(roles, "actor_id int, film_id int"),
        actor=spark.createDataFrame(names, "actor_id int, first_name string, last_name string"),
    )


@pytest.mark.parametrize(
    "counts, k, strict, kept",
    [
        ((5, 4, 3, 3, 2), 3, False, [5, 4, 3, 3]),
        ((5, 4, 3, 3, 2), 4, True, [5, 4, 3, 3]),
        ((5, 4, 3, 2, 2), 3, False, [5, 4, 3]),
        ((5, 4, 3, 2, 2), 4, True, [5, 4, 3, 2, 2]),
        ((3, 2, 1), 4, True, []),
        ((3, 2, 1), 4, False, [3, 2, 1]),
    ],
)
def test_h5_top_actors(spark, t, counts, k, strict, kept):
    found = rows(q.top_actors_in_category(children(spark, t, *counts), "Children", k, strict))
    assert [r[2] for r in found] == kept


def test_h5_same_name_is_two_actors(t):
    found = rows(q.top_actors_in_category(t, "Drama", 3))
    assert found == [("Ann", "Lee", 2), ("Ann", "Lee", 1), ("Cy", "Fox", 1)]


def test_h6_one_row_per_city(t):
    # active is 1 and 2 in city 1, 0 in city 2, unknown in city 3.
    assert rows(q.customers_by_state_per_city(t)) == [
        ("aa-b", 1, 1), ("x-y", 0, 1), ("Abc", 0, 0), ("nowhere", 0, 0), ("no customers", 0, 0),
    ]


def test_h6_one_row_per_group(t):
    found = rows(q.customers_by_state_per_group(t))
    assert sorted(found) == sorted([
        ("aa-b", 1, 1), ("aa-b", 1, 1), ("x-y", 0, 1), ("Abc", 0, 0), ("nowhere", 0, 0), ("no customers", 0, 0),
    ])


def test_h6_groups_count_null_extended_rows(t):
    found = {(r.city, r.active): r.customer_count for r in q.customer_groups(t).collect()}
    assert found == {
        ("aa-b", 1): 1, ("aa-b", 2): 1, ("x-y", 0): 1, ("Abc", None): 1, ("nowhere", None): 1, ("no customers", None): 1,
    }


def test_h7_one_pass_over_both_city_sets(t):
    # City aa-b both starts with a and has a dash: film 1 (Drama, Children) 3 days, film 4 (Drama) 4 days.
    # City x-y has a dash: film 2 (Drama) 40 days 5 hours, film 4 (Drama) 1 day. Abc has a capital A.
    found = {(r[0], r[1].months, r[1].days, r[1].micros) for r in rows(q.longest_rented_categories(t))}
    assert found == {("Drama", 0, 7, 0), ("Drama", 1, 18, 5 * 3600 * 1_000_000)}


def test_h7_equal_winners_merge_unless_tagged(t):
    one_city = dict(t, rental=t["rental"].filter("customer_id = 1"))
    merged = q.longest_rented_categories(one_city)
    assert [(r[0], r[1].days) for r in rows(merged)] == [("Drama", 7)]
    tagged = q.longest_rented_categories(one_city, tagged=True)
    assert sorted(r.cities for r in tagged.collect()) == ["contains", "starts"]


def test_h7_original_key_matches_rental_numbers(t):
    # Only rental 10 has the number of an item; it is an item of film 1, kept 4 days in city aa-b.
    found = q.longest_rented_categories(t, rental_key="rental_id", tagged=True)
    assert sorted((r.cat_name, r.rental_duration.days, r.cities) for r in found.collect()) == [
        ("Children", 4, "contains"), ("Children", 4, "starts"),
    ]


def test_h7_unknown_duration_ranks_first(t):
    found = q.longest_rented_categories(t, prefix="A", infix="-", tagged=True)
    assert {(r.cat_name, r.cities) for r in found.collect() if r.rental_duration is None} == {("Children", "starts")}


def test_h7_no_city_gives_no_row(t):
    assert rows(q.longest_rented_categories(t, prefix="q", infix="q")) == []
