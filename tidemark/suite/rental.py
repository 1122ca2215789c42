"""Rental queries on the given tables.

The key chains of the rental schema are played by those of the order tables; see ``bind_*``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import rental as q
from tidemark.suite.registry import Tables, money, register


def renamed(df, **columns):
    """``renamed(df, new="old")``."""
    return df.select(*[(F.col(old) if isinstance(old, str) else old).alias(new) for new, old in columns.items()])


def bind_films(t: Tables):
    """category = nation, film_category = its customers, film = their orders."""
    return {
        "category": renamed(t.nation, category_id="n_nationkey", name="n_name"),
        "film_category": renamed(t.customer, film_id="c_custkey", category_id="c_nationkey"),
        "film": renamed(t.orders, film_id="o_custkey", title="o_orderpriority"),
    }


def bind_actors(t: Tables):
    """actor = supplier, whose films are the nation's; inventory = customers there, rental = orders."""
    return {
        "actor": renamed(t.supplier, actor_id="s_suppkey", first_name="s_name", last_name=F.lit("Ltd")),
        "film_actor": renamed(t.supplier, actor_id="s_suppkey", film_id="s_nationkey"),
        "inventory": renamed(t.customer, inventory_id="c_custkey", film_id="c_nationkey"),
        "rental": renamed(t.orders, rental_id="o_orderkey", inventory_id="o_custkey"),
    }


def bind_money(t: Tables):
    """region > nation > customer > orders > lineitem."""
    return {
        "category": renamed(t.region, category_id="r_regionkey", name="r_name"),
        "film_category": renamed(t.nation, film_id="n_nationkey", category_id="n_regionkey"),
        "inventory": renamed(t.customer, inventory_id="c_custkey", film_id="c_nationkey"),
        "rental": renamed(t.orders, rental_id="o_orderkey", inventory_id="o_custkey"),
        "payment": renamed(t.lineitem, rental_id="l_orderkey", amount=money("l_extendedprice")),
    }


def bind_suppliers(t: Tables):
    """actor = supplier on order lines, film = order, category = customer with its market segment."""
    return {
        "actor": renamed(t.supplier, actor_id="s_suppkey", first_name="s_name", last_name=F.lit("Ltd")),
        "film_actor": renamed(t.lineitem, actor_id="l_suppkey", film_id="l_orderkey"),
        "film_category": renamed(t.orders, film_id="o_orderkey", category_id="o_custkey"),
        "category": renamed(t.customer, category_id="c_custkey", name="c_mktsegment"),
    }


def bind_states(t: Tables):
    """city = nation, address = customer, customer = order; status F is active, O is not, P unknown."""
    status = F.col("o_orderstatus")
    active = F.when(status == "F", 1).when(status == "O", 0)
    return {
        "city": renamed(t.nation, city_id="n_nationkey", city="n_name"),
        "address": renamed(t.customer, address_id="c_custkey", city_id="c_nationkey"),
        "customer": renamed(t.orders, customer_id="o_orderkey", address_id="o_custkey", active=active),
    }


def bind_durations(t: Tables):
    """rental = order line from order to shipment; category = supplier's region, city = customer's."""
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return {
        "category": renamed(t.region, category_id="r_regionkey", name="r_name"),
        "film_category": renamed(t.nation, film_id="n_nationkey", category_id="n_regionkey"),
        "inventory": renamed(t.supplier, inventory_id="s_suppkey", film_id="s_nationkey"),
        "rental": renamed(
            lines,
            inventory_id="l_suppkey",
            rental_id="l_partkey",
            customer_id="o_custkey",
            rental_date="o_orderdate",
            return_date="l_shipdate",
        ),
        "customer": renamed(t.customer, customer_id="c_custkey", address_id="c_nationkey"),
        "address": renamed(t.nation, address_id="n_nationkey", city_id="n_regionkey"),
        "city": renamed(t.region, city_id="r_regionkey", city="r_name"),
    }


@register("h1_films_per_category", """
    SELECT n_name AS category_name, count(*) AS film_count
    FROM nation JOIN customer ON n_nationkey = c_nationkey JOIN orders ON o_custkey = c_custkey
    GROUP BY n_nationkey, n_name""")
def _(t):
    return q.films_per_category(bind_films(t))


@register("h2_most_rented_actors", """
    SELECT s_name AS first_name, 'Ltd' AS last_name, count(*) AS rental_count
    FROM supplier JOIN customer ON s_nationkey = c_nationkey JOIN orders ON o_custkey = c_custkey
    GROUP BY s_suppkey, s_name ORDER BY rental_count DESC, s_suppkey LIMIT 10""")
def _(t):
    return q.most_rented_actors(bind_actors(t))


MONEY_SQL = """
    FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey
    JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY r_regionkey, r_name"""


@register("h3_top_category_by_money", f"""
    SELECT r_name AS category_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    {MONEY_SQL} ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, r_regionkey LIMIT 1""")
def _(t):
    return q.top_category_by_money(bind_money(t))


@register("h3_money_per_category", f"""
    SELECT r_regionkey AS category_id, r_name AS category_name,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount {MONEY_SQL}""")
def _(t):
    return q.money_per_category(bind_money(t))


@register("h4_films_not_in_inventory", """
    SELECT o_orderkey AS film_id, o_orderpriority AS title FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def _(t):
    return q.films_not_in_inventory({
        "film": renamed(t.orders, film_id="o_orderkey", title="o_orderpriority"),
        "inventory": renamed(t.lineitem, inventory_id="l_linenumber", film_id="l_orderkey"),
    })


TOP_ACTORS_SQL = """
    WITH a AS (
        SELECT s_suppkey, s_name AS first_name, 'Ltd' AS last_name, count(*) AS film_count
        FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey
        JOIN customer ON c_custkey = o_custkey AND c_mktsegment = 'BUILDING'
        GROUP BY s_suppkey, s_name)
    SELECT first_name, last_name, film_count FROM a
    WHERE film_count >= (SELECT film_count FROM a ORDER BY film_count DESC LIMIT 1 OFFSET {offset})"""


@register("h5_top_actors_in_category", TOP_ACTORS_SQL.format(offset=2))
def _(t):
    return q.top_actors_in_category(bind_suppliers(t), "BUILDING", 3)


@register("h5_top_actors_as_offset", TOP_ACTORS_SQL.format(offset=3))
def _(t):
    return q.top_actors_in_category(bind_suppliers(t), "BUILDING", 4, strict_threshold=True)


@register("h6_customers_by_state", """
    SELECT n_name AS city,
           count(*) FILTER (WHERE o_orderstatus = 'F') AS active_customer_count,
           count(*) FILTER (WHERE o_orderstatus = 'O') AS passive_customer_count
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY n_nationkey, n_name""")
def _(t):
    return q.customers_by_state_per_city(bind_states(t))


@register("h6_customers_by_state_per_group", """
    WITH g AS (
        SELECT n_nationkey AS k, n_name AS city,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS active, count(*) AS n
        FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
        GROUP BY 1, 2, 3)
    SELECT g.city, coalesce(a.n, 0) AS active_customer_count, coalesce(p.n, 0) AS passive_customer_count
    FROM g LEFT JOIN g AS a ON a.k = g.k AND a.active = 1 LEFT JOIN g AS p ON p.k = g.k AND p.active <> 1""")
def _(t):
    return q.customers_by_state_per_group(bind_states(t))


DURATION_SQL = """
    WITH d AS (
        SELECT cr.r_name AS cat_name, hr.r_name AS city, date_diff('microsecond', o_orderdate, l_shipdate) AS us
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON s_suppkey = {key} JOIN nation cn ON s_nationkey = cn.n_nationkey
        JOIN region cr ON cn.n_regionkey = cr.r_regionkey
        JOIN customer ON c_custkey = o_custkey JOIN nation hn ON c_nationkey = hn.n_nationkey
        JOIN region hr ON hn.n_regionkey = hr.r_regionkey),
    s AS (SELECT cat_name, sum(us) AS us FROM d WHERE city LIKE 'A%' GROUP BY 1 ORDER BY us DESC, 1 LIMIT 1),
    c AS (SELECT cat_name, sum(us) AS us FROM d WHERE city LIKE '%E%' GROUP BY 1 ORDER BY us DESC, 1 LIMIT 1),
    u AS (SELECT {tag_s} * FROM s UNION SELECT {tag_c} * FROM c)
    SELECT {out} cat_name, CAST(us // 2592000000000 AS BIGINT) AS months,
           CAST(us // 86400000000 % 30 AS BIGINT) AS days, CAST(us % 86400000000 AS BIGINT) AS micros FROM u"""


def _durations(df):
    return df.select(*[c for c in df.columns if c != "rental_duration"], "rental_duration.*")


@register("h7_longest_rented_categories", DURATION_SQL.format(key="l_suppkey", tag_s="", tag_c="", out=""))
def _(t):
    return _durations(q.longest_rented_categories(bind_durations(t), "A", "E"))


@register("h7_longest_rented_tagged", DURATION_SQL.format(
    key="l_suppkey", tag_s="'starts' AS cities,", tag_c="'contains' AS cities,", out="cities,"))
def _(t):
    return _durations(q.longest_rented_categories(bind_durations(t), "A", "E", tagged=True))


@register("h7_longest_rented_by_rental_number", DURATION_SQL.format(key="l_partkey", tag_s="", tag_c="", out=""))
def _(t):
    return _durations(q.longest_rented_categories(bind_durations(t), "A", "E", rental_key="rental_id"))
