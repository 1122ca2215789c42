"""Single operators: projections, filters, joins, aggregates, sorts, sets, subqueries, scalars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import dates, intervals, payloads
from tidemark.operators import distinct, ordering, relational, selection, setops, skew
from tidemark.session import checkpointed
from tidemark.suite import flights as bound
from tidemark.suite import rental as bound_rental
from tidemark.suite.registry import Tables, money, register

PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"


# --- scan, projections, predicates -----------------------------------------------------------


@register("s01_table_scan", "SELECT * FROM customer")
def _(t):
    return t.customer


@register("p01_column_projection", "SELECT p_name, p_retailprice FROM part")
def _(t):
    return t.part.select("p_name", "p_retailprice")


@register("p02_star_over_join", """
    SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
           n.n_nationkey AS n_n_nationkey, n.n_name AS n_n_name, n.n_regionkey AS n_n_regionkey
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def _(t):
    nation = relational.prefixed(t.nation, "n")
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_n_nationkey")).select("*")


@register("p03_alias", "SELECT c.c_custkey AS customer_id, c.c_name AS customer_name FROM customer AS c")
def _(t):
    c = t.customer.alias("c")
    return c.select(F.col("c.c_custkey").alias("customer_id"), F.col("c.c_name").alias("customer_name"))


@register("p04_literal_tag", "SELECT o_orderkey, 'Booked' AS st FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.lit("Booked").alias("st"))


@register("p05_arithmetic_over_aggregate", f"""
    SELECT o_orderpriority, ({bound.mean_sql("o_totalprice")} + 2000) / 100.0::DOUBLE AS avg_plus_20
    FROM orders GROUP BY 1""")
def _(t):
    priced = t.orders.withColumn("amount", money("o_totalprice"))
    return priced.groupBy("o_orderpriority").agg((relational.rounded_mean("amount") + 20).alias("avg_plus_20"))


ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
ORDER_SQL = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE"


@register("p06_equality", f"{ORDER_SQL} o_orderstatus = 'F'")
def _(t):
    return t.orders.filter(F.col("o_orderstatus") == "F").select(*ORDER_COLUMNS)


@register("p07_conjunction", f"{ORDER_SQL} o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def _(t):
    both = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")
    return t.orders.filter(both).select(*ORDER_COLUMNS)


@register("p08_disjunction", f"{ORDER_SQL} o_orderstatus = 'F' OR o_orderpriority = '2-HIGH'")
def _(t):
    either = (F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "2-HIGH")
    return t.orders.filter(either).select(*ORDER_COLUMNS)


@register("p09_membership", f"{ORDER_SQL} o_orderpriority IN ('1-URGENT', '5-LOW')")
def _(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select(*ORDER_COLUMNS)


@register("p10_prefix_match", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'b%'")
def _(t):
    return t.part.filter(F.col("p_name").like("b%")).select("p_partkey", "p_name")


@register("p11_contains_match", "SELECT doc_id FROM documents WHERE text LIKE '%R%'")
def _(t):
    return t.documents.filter(F.col("text").contains("R")).select("doc_id")


@register("p12_null_test", """
    SELECT o_orderkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL""")
def _(t):
    departed = t.lineitem.select("l_orderkey").distinct()
    joined = t.orders.join(departed, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.filter(F.col("l_orderkey").isNull()).select("o_orderkey")


@register("p13_not_equal_with_null", """
    SELECT o_orderkey FROM (
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS active FROM orders)
    WHERE active <> 1""")
def _(t):
    return bound_rental.bind_states(t)["customer"].filter(F.col("active") != 1).select(
        F.col("customer_id").alias("o_orderkey")
    )


@register("p14_date_equality", "SELECT event_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-14'")
def _(t):
    return t.events.filter(dates.on_day("ts", dt.date(2024, 1, 14))).select("event_id", "value")


@register("p15_scalar_threshold", """
    WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_custkey, n FROM c WHERE n >= (SELECT n FROM c ORDER BY n DESC LIMIT 1 OFFSET 99)""")
def _(t):
    counts = relational.group_count(t.orders, "o_custkey")
    return counts.filter(F.col("n") >= ordering.kth_largest(counts, 100, "n").scalar())


@register("p16_equals_scalar_aggregate", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)""")
def _(t):
    largest = t.lineitem.agg(F.max("l_quantity")).scalar()
    return t.lineitem.filter(F.col("l_quantity") == largest).select("l_orderkey", "l_linenumber", "l_quantity")


@register("p17_filter_in_derived_table", """
    SELECT c_custkey, o_orderkey IS NOT NULL AS pending, coalesce(o_orderkey, -1) AS o_orderkey FROM customer
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') t1 ON o_custkey = c_custkey""")
def _(t):
    t1 = t.orders.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return relational.left_join(t.customer.select("c_custkey"), t1, "c_custkey").select(
        "c_custkey",
        F.col("o_orderkey").isNotNull().alias("pending"),
        F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"),
    )


# --- joins -----------------------------------------------------------------------------------


@register("j01_inner_join", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@register("j02_join_chain", """
    SELECT l_orderkey, l_linenumber, c_name, n_name, r_name FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    return relational.join_chain(
        lines,
        (t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey"),
        (t.customer.select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey")), "c_custkey"),
        (t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey"),
        (t.region, "r_regionkey"),
    ).select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "c_name", "n_name", "r_name")


@register("j03_many_to_many_join", """
    SELECT s_suppkey, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM supplier JOIN customer ON s_nationkey = c_nationkey GROUP BY 1""")
def _(t):
    customers = t.customer.groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("c_acctbal")).alias("balance")
    )
    return skew.roll_up(customers, t.supplier, on="s_nationkey", to="s_suppkey", many=True)


@register("j03_many_to_many_rows", """
    SELECT s_suppkey, c_custkey, c_acctbal FROM supplier JOIN customer ON s_nationkey = c_nationkey""")
def _(t):
    suppliers = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nation"))
    customers = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").alias("nation"))
    return skew.grid_join(suppliers, customers, "nation").drop("nation")


@register("j04_constant_in_join_condition", """
    SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""")
def _(t):
    building = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return t.orders.join(building, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_custkey")


@register("j05_left_outer_chain", """
    SELECT n_name, coalesce(c_custkey, -1) AS c_custkey, coalesce(o_orderkey, -1) AS o_orderkey FROM nation
    LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey""")
def _(t):
    customers = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey")
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    nations = t.nation.select("n_nationkey", "n_name")
    chain = relational.left_join(relational.left_join(nations, customers, "n_nationkey"), orders, "c_custkey")
    none = F.lit(-1)
    return chain.select(
        "n_name", F.coalesce("c_custkey", none).alias("c_custkey"), F.coalesce("o_orderkey", none).alias("o_orderkey")
    )


@register("j06_left_join_filtered_after", """
    SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderstatus = 'P'""")
def _(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.filter(F.col("o_orderstatus") == "P").select("l_orderkey", "l_linenumber", "o_custkey")


@register("j07_left_join_filtered_before", """
    SELECT l_orderkey, l_linenumber, coalesce(o_custkey, -1) AS o_custkey FROM lineitem
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON l_orderkey = o_orderkey""")
def _(t):
    pending = t.orders.filter(F.col("o_orderstatus") == "P")
    joined = t.lineitem.join(pending, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select("l_orderkey", "l_linenumber", F.coalesce("o_custkey", F.lit(-1)).alias("o_custkey"))


@register("j08_anti_join", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.anti_join(t.orders.select("o_orderkey", "o_custkey"), lines, "o_orderkey")


@register("j09_self_join_of_groups", """
    WITH g AS (SELECT o_custkey AS k, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT g.k, g.s, coalesce(f.n, 0) AS n_f, coalesce(o.n, 0) AS n_o
    FROM g LEFT JOIN g AS f ON f.k = g.k AND f.s = 'F' LEFT JOIN g AS o ON o.k = g.k AND o.s = 'O'""")
def _(t):
    groups = relational.group_count(t.orders, F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("s"))
    g = checkpointed(groups)
    f = g.filter("s = 'F'").select("k", F.col("n").alias("f_n"))
    o = g.filter("s = 'O'").select("k", F.col("n").alias("o_n"))
    return g.join(f, "k", "left").join(o, "k", "left").select(
        "k", "s", F.coalesce("f_n", F.lit(0)).alias("n_f"), F.coalesce("o_n", F.lit(0)).alias("n_o")
    )


# --- aggregates ------------------------------------------------------------------------------


@register("a01_global_count", "SELECT count(*) AS n FROM lineitem")
def _(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@register("a02_filtered_count", "SELECT count(*) AS n FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '1998-09-02'")
def _(t):
    return t.lineitem.filter(dates.on_day("l_shipdate", dt.date(1998, 9, 2))).agg(F.count(F.lit(1)).alias("n"))


@register("a03_global_min_max_sum", """
    SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem""")
def _(t):
    amount = money("l_extendedprice")
    return t.lineitem.agg(F.min(amount).alias("low"), F.max(amount).alias("high"), F.sum(amount).alias("total"))


@register("a04_global_multi_aggregate", f"""
    SELECT count(*) AS n, min(l_extendedprice) AS min_amount, max(l_extendedprice) AS max_amount,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
           {bound.mean_sql("l_extendedprice")} / 100.0::DOUBLE AS avg_amount FROM lineitem""")
def _(t):
    return t.lineitem.select(money("l_extendedprice").alias("amount")).agg(*relational.amount_stats("amount"))


@register("a05_grouped_count", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return relational.group_count(t.lineitem, "l_partkey")


@register("a06_group_with_dependent_column", """
    SELECT s_suppkey, s_name, count(*) AS n FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def _(t):
    counts = relational.group_count(t.lineitem, F.col("l_suppkey").alias("s_suppkey"))
    return counts.join(t.supplier.select("s_suppkey", "s_name"), "s_suppkey")


@register("a07_group_by_expression", """
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    return relational.group_count(t.lineitem, dates.day("l_shipdate").alias("day"))


@register("a08_grouped_multi_aggregate", f"""
    SELECT l_suppkey, count(*) AS n, min(l_extendedprice) AS min_amount, max(l_extendedprice) AS max_amount,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_amount,
           {bound.mean_sql("l_extendedprice")} / 100.0::DOUBLE AS avg_amount
    FROM lineitem GROUP BY 1""")
def _(t):
    lines = t.lineitem.select("l_suppkey", money("l_extendedprice").alias("amount"))
    return lines.groupBy("l_suppkey").agg(*relational.amount_stats("amount"))


@register("a09_distinct_count", """
    SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1, 2""")
def _(t):
    return relational.group_distinct(t.lineitem, ["l_returnflag", "l_linestatus"], "l_partkey", "parts")


@register("a09_distinct_dense_keys", """
    SELECT l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1, 2""")
def _(t):
    return distinct.group_distinct_dense(t.lineitem, ["l_returnflag", "l_linestatus"], "l_orderkey", "orders")


@register("a09_distinct_of_merged_states", """
    SELECT o_orderpriority, o_orderstatus, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1, 2""")
def _(t):
    """Each year's orders are counted into a state of its own; the states are merged, without the orders."""
    keys, year = ["o_orderpriority", "o_orderstatus"], F.year("o_orderdate")
    bounds = t.orders.agg(F.min(year), F.max(year)).first()
    years = [t.orders.where(year == y) for y in range(bounds[0], bounds[1] + 1)]
    states = [checkpointed(distinct.distinct_state(orders, keys, "o_custkey")) for orders in years]
    return distinct.distinct_count(distinct.merge_states(*states), "customers")


@register("a10_money_sum", f"""
    SELECT o_custkey, CAST(sum({PRICE}) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total"))


INTERVAL_SQL = """
    SELECT l_suppkey, CAST(sum(date_diff('microsecond', o_orderdate, l_shipdate)) AS VARCHAR) AS micros
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""


def _lags(t: Tables):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.groupBy("l_suppkey").agg(intervals.elapsed_sum("l_shipdate", "o_orderdate").alias("micros"))


def _as_text(lags):
    """Sums beyond 2^53 keep all their digits as text only."""
    return lags.withColumn("micros", F.col("micros").cast("decimal(38,0)").cast("string"))


@register("a11_interval_sum", INTERVAL_SQL)
def _(t):
    return _as_text(_lags(t))


@register("a12_two_level_aggregate", f"""
    WITH c AS (SELECT o_custkey, sum({PRICE}) AS total FROM orders GROUP BY 1)
    SELECT c_mktsegment, CAST(sum(total) AS DOUBLE) AS total, count(*) AS customers
    FROM c JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def _(t):
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(money("o_totalprice")).alias("total"), F.lit(1).alias("customers")
    )
    return skew.roll_up(per_customer, t.customer, on="c_custkey", to="c_mktsegment")


@register("a13_null_extended_count", """
    SELECT o_orderkey, count(*) AS joined_rows, count(l_orderkey) AS matches
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.null_extended_counts(t.orders.select("o_orderkey"), lines, "o_orderkey")


@register("a14_counts_per_state", """
    SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS active,
           count(*) FILTER (WHERE o_orderstatus = 'O') AS passive FROM orders GROUP BY 1""")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("active"),
        F.count_if(F.col("o_orderstatus") == "O").alias("passive"),
    )


@register("a15_distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


# --- sorts and limits ------------------------------------------------------------------------


@register("o01_sort_descending", "SELECT p_partkey, p_retailprice FROM part ORDER BY 2 DESC NULLS FIRST, 1")
def _(t):
    return ordering.sort_desc(t.part.select("p_partkey", "p_retailprice"), "p_retailprice", tie="p_partkey")


@register("o02_sort_by_alias", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1")
def _(t):
    return ordering.sort_desc(relational.group_count(t.lineitem, "l_partkey"), "n", tie="l_partkey")


@register("o03_sort_by_ordinal", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2, 3""")
def _(t):
    counts = relational.group_count(t.orders, "o_orderstatus", "o_orderpriority")
    return counts.orderBy(*[ordering.asc(name) for name in counts.columns])


@register("o04_sort_by_two_keys", """
    SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY 2 DESC NULLS FIRST, 3 DESC NULLS FIRST, 1""")
def _(t):
    customers = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return ordering.sort_desc(customers, "c_nationkey", "c_acctbal", tie="c_custkey")


@register("o05_top_n", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def _(t):
    return ordering.top_n(relational.group_count(t.lineitem, "l_partkey"), 10, "n", tie="l_partkey")


@register("o06_top_group", f"""
    SELECT o_custkey, CAST(sum({PRICE}) AS DOUBLE) AS total FROM orders
    GROUP BY 1 ORDER BY sum({PRICE}) DESC NULLS FIRST, 1 LIMIT 1""")
def _(t):
    totals = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total"))
    return ordering.top_n(totals, 1, "total", tie="o_custkey")


@register("o07_top_row", """
    SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC NULLS FIRST, l_orderkey, l_partkey LIMIT 1""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice")
    order = [ordering.desc("l_extendedprice"), ordering.asc("l_orderkey"), ordering.asc("l_partkey")]
    return lines.orderBy(*order).limit(1)


TIES_SQL = """
    WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_custkey, n FROM c WHERE n >= (SELECT n FROM c ORDER BY n DESC LIMIT 1 OFFSET {0})"""


@register("o08_top_k_with_ties", TIES_SQL.format(2))
def _(t):
    return ordering.top_k_with_ties(relational.group_count(t.orders, "o_custkey"), 3, "n")


@register("o08_top_k_strict_threshold", TIES_SQL.format(3))
def _(t):
    return ordering.top_k_with_ties(relational.group_count(t.orders, "o_custkey"), 4, "n", strict_threshold=True)


@register("o08_half_of_the_groups_with_ties", """
    WITH c AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CAST(total AS DOUBLE) AS total FROM c
    WHERE total >= (SELECT total FROM c ORDER BY total DESC LIMIT 1 OFFSET (SELECT count(*) // 2 FROM c))""")
def _(t):
    """Orders whose price reaches that of the middle one."""
    totals = checkpointed(t.lineitem.groupBy("l_orderkey").agg(F.sum(money("l_extendedprice")).alias("total")))
    middle = selection.nth_largest(totals, totals.count() // 2 + 1, "total")
    return totals.filter(F.col("total") >= middle.scalar())


@register("o09_limit_without_order", "SELECT count(*) AS n FROM (SELECT * FROM lineitem LIMIT 2)")
def _(t):
    return t.lineitem.limit(2).agg(F.count(F.lit(1)).alias("n"))


@register("o10_sort_by_interval", INTERVAL_SQL + " ORDER BY CAST(micros AS HUGEINT) DESC NULLS FIRST, 1 LIMIT 10")
def _(t):
    return _as_text(ordering.top_n(_lags(t), 10, "micros", tie="l_suppkey"))


# --- set operations --------------------------------------------------------------------------


# All orders, split at a date into an earlier and a later half; the range reaches the scan.
SPLIT = "1998-05-01"


def _buyers(t: Tables, later: bool):
    split = F.lit(SPLIT).cast("timestamp_ntz")
    half = F.col("o_orderdate") >= split if later else F.col("o_orderdate") < split
    return t.orders.filter(half).select("o_custkey")


def _buyers_sql(sign: str) -> str:
    return f"SELECT o_custkey FROM orders WHERE o_orderdate {sign} TIMESTAMP '{SPLIT}'"


EARLY, LATE = False, True
EARLY_SQL, LATE_SQL = _buyers_sql("<"), _buyers_sql(">=")


@register("u01_union_of_tagged_aggregates", """
    SELECT o_orderpriority, count(*) AS n, 'Planned' AS st FROM orders WHERE o_orderstatus = 'P' GROUP BY 1
    UNION
    SELECT o_orderpriority, count(*) AS n, 'Already completed' AS st FROM orders
    WHERE o_orderstatus = 'F' GROUP BY 1""")
def _(t):
    def branch(status: str, tag: str):
        chosen = t.orders.filter(F.col("o_orderstatus") == status)
        return relational.group_count(chosen, "o_orderpriority").withColumn("st", F.lit(tag))

    united = setops.union_distinct(branch("P", "Planned"), branch("F", "Already completed"))
    return united.orderBy(*[ordering.asc(name) for name in united.columns])


@register("u02_union_distinct", f"{EARLY_SQL} UNION {LATE_SQL}")
def _(t):
    return setops.union_distinct(_buyers(t, EARLY), _buyers(t, LATE))


@register("u03_union_all", f"{EARLY_SQL} UNION ALL {LATE_SQL}")
def _(t):
    return setops.union_all(_buyers(t, EARLY), _buyers(t, LATE))


@register("l23_union_of_constants", "SELECT 1 AS one FROM orders UNION SELECT 1 AS one FROM lineitem")
def _(t):
    one = F.lit(1).alias("one")
    return setops.union_distinct(t.orders.select(one), t.lineitem.select(one))


@register("l23_union_all_of_constants", "SELECT 1 AS one FROM orders UNION ALL SELECT 1 AS one FROM lineitem")
def _(t):
    one = F.lit(1).alias("one")
    return setops.union_all(t.orders.select(one), t.lineitem.select(one))


def _best_segment_sql(region: int) -> str:
    return f"""(SELECT c_mktsegment, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = {region}
        GROUP BY 1 ORDER BY 2 DESC NULLS FIRST, 1 LIMIT 1)"""


@register("u04_union_of_top_groups", f"{_best_segment_sql(0)} UNION {_best_segment_sql(3)}")
def _(t):
    homes = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    first, second = F.col("n_regionkey") == 0, F.col("n_regionkey") == 3
    totals = homes.filter(first | second).groupBy("c_mktsegment").agg(
        F.count_if(first).alias("first_n"),
        F.sum(F.when(first, money("c_acctbal"))).alias("first_balance"),
        F.count_if(second).alias("second_n"),
        F.sum(F.when(second, money("c_acctbal"))).alias("second_balance"),
    )
    return ordering.top_per_condition(totals, "c_mktsegment", "balance", ["first", "second"])


@register("u05_difference", f"{EARLY_SQL} EXCEPT {LATE_SQL}")
def _(t):
    return setops.difference(_buyers(t, EARLY), _buyers(t, LATE))


@register("u06_intersection", f"{EARLY_SQL} INTERSECT {LATE_SQL}")
def _(t):
    return setops.intersection(_buyers(t, EARLY), _buyers(t, LATE))


@register("u07_symmetric_difference", f"({EARLY_SQL} EXCEPT {LATE_SQL}) UNION ALL ({LATE_SQL} EXCEPT {EARLY_SQL})")
def _(t):
    return setops.symmetric_difference(_buyers(t, EARLY), _buyers(t, LATE))


@register("u08_one_side_of_symmetric_difference", f"{LATE_SQL} EXCEPT {EARLY_SQL}")
def _(t):
    return setops.only_in_second(_buyers(t, EARLY), _buyers(t, LATE))


# --- subqueries ------------------------------------------------------------------------------


@register("c01_named_relation_with_columns", """
    WITH c (customer_id, order_count) AS (SELECT o_custkey, count(*) FROM orders GROUP BY 1)
    SELECT customer_id, order_count FROM c""")
def _(t):
    return relational.group_count(t.orders, "o_custkey").toDF("customer_id", "order_count")


@register("c02_named_relation_used_twice", """
    WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
    SELECT o_custkey, n FROM c WHERE n = (SELECT max(n) FROM c)""")
def _(t):
    counts = relational.group_count(t.orders, "o_custkey")
    return counts.filter(F.col("n") == counts.agg(F.max("n")).scalar())


@register("c03_derived_table", """
    SELECT c_mktsegment, count(o_orderkey) AS n FROM customer
    LEFT JOIN (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') t1 ON o_custkey = c_custkey
    GROUP BY 1""")
def _(t):
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    counted = relational.null_extended_counts(t.customer.select("c_custkey", "c_mktsegment"), urgent, "c_custkey")
    return counted.groupBy("c_mktsegment").agg(F.sum("matches").alias("n"))


@register("c04_nth_value", "SELECT o_totalprice FROM orders ORDER BY 1 DESC NULLS FIRST LIMIT 1 OFFSET 3")
def _(t):
    return ordering.kth_largest(t.orders, 4, "o_totalprice")


@register("c04_nth_value_at_a_deep_offset", """
    SELECT l_extendedprice FROM lineitem ORDER BY 1 DESC NULLS FIRST LIMIT 1 OFFSET (SELECT count(*) // 2 FROM lineitem)""")
def _(t):
    return selection.nth_largest(t.lineitem, t.lineitem.count() // 2 + 1, "l_extendedprice")


# --- scalar functions ------------------------------------------------------------------------


@register("f01_day_of_timestamp", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(t):
    return t.events.select("event_id", dates.day("ts").alias("day"))


@register("f02_round", """
    SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
           * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS rebate FROM lineitem""")
def _(t):
    rebate = F.round(money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"), 2)
    return t.lineitem.select("l_orderkey", "l_linenumber", rebate.alias("rebate"))


@register("f03_coalesce", """
    SELECT o_orderkey, coalesce(q, 0) AS quantity FROM orders
    LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def _(t):
    ordered = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q"))
    joined = t.orders.select("o_orderkey").join(ordered, "o_orderkey", "left")
    return joined.select("o_orderkey", F.coalesce("q", F.lit(0.0)).alias("quantity"))


@register("f04_timestamp_difference", """
    SELECT l_orderkey, l_linenumber, date_diff('microsecond', o_orderdate, l_shipdate) AS micros
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    micros = intervals.elapsed_micros("l_shipdate", "o_orderdate")
    return lines.select("l_orderkey", "l_linenumber", micros.alias("micros"))


@register("f05_justify_interval", """
    WITH d AS (SELECT user_id, sum(date_diff('microsecond', TIMESTAMP '2024-01-15', ts)) AS us FROM events GROUP BY 1)
    SELECT user_id, CAST(trunc(us / 2592000000000) AS BIGINT) AS months,
           CAST(trunc(us / 86400000000) AS BIGINT) % 30 AS days, CAST(us % 86400000000 AS BIGINT) AS micros FROM d""")
def _(t):
    middle = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    sums = t.events.withColumn("middle", middle).groupBy("user_id").agg(
        intervals.elapsed_sum("ts", "middle").alias("us")
    )
    return sums.select("user_id", intervals.justify_interval(F.col("us")).alias("i")).select("user_id", "i.*")


@register("f06_parse_day", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(t):
    text = F.substring(F.col("ts").cast("string"), 1, 10)
    return t.events.select("event_id", dates.parse_day(text).alias("day"))


@register("f07_format_day", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def _(t):
    return t.orders.select("o_orderkey", dates.format_day(dates.day("o_orderdate")).alias("day"))


@register("f08_day_range", """
    SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS open_orders FROM (
        SELECT unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 6, INTERVAL 1 DAY)) AS day
        FROM orders) GROUP BY 1""")
def _(t):
    first = dates.day("o_orderdate")
    days = t.orders.select(F.explode(dates.day_sequence(first, F.date_add(first, 6))).alias("day"))
    return relational.group_count(days, "day", name="open_orders")


@register("f09_json_payload", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
           '{"k":' || CAST(CAST(json_extract(props, '$.k') AS DOUBLE) AS VARCHAR) || '}' AS encoded FROM events""")
def _(t):
    decoded = t.events.select("event_id", payloads.decode_numbers("props").alias("m"))
    return decoded.select("event_id", F.col("m")["k"].alias("k"), payloads.encode(F.col("m")).alias("encoded"))
