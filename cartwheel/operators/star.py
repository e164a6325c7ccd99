"""Star-join building blocks over :class:`cartwheel.sources.tables.Shop`.

Two shapes are offered:

* :func:`order_details` -- the row-level denormalised view
  (orders ⨝ customers ⨝ products), for row outputs;
* pre-aggregates (:func:`customer_month_totals`, :func:`customer_totals`,
  :func:`product_quantities`) that collapse the order lines to the grain
  the report needs *before* the remaining dimension joins. Spark does not
  push aggregates below joins by itself; doing it here keeps the second and
  third fact-sized shuffles out of the plan. Exactness is kept: sums are
  decimal, counts are re-summed, and because the dimension joins happen
  after the partial aggregate with the same inner semantics, duplicate or
  missing dimension keys give the same multiplicities as the row-level join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.sources.tables import Shop, join_heads


def month_of(date_col: str = "order_date"):
    """First day of the month, as DATE (``trunc`` keeps the DATE type)."""
    return F.trunc(F.col(date_col), "MM")


def meet_heads(lines: DataFrame, heads: DataFrame, tasks: int) -> DataFrame:
    """lines ⨝ heads on order_id, dealt over so many tasks (see
    :func:`cartwheel.session.task_count`): what a task sorts, and then combines
    before the next shuffle, stays of one size as the tables grow. AQE leaves
    such a shuffle alone, so the lines of one order stay in one task, sorted on
    disk where they must be."""
    return lines.repartition(tasks, "order_id").join(heads.repartition(tasks, "order_id").hint("merge"), "order_id")


def order_details(shop: Shop, with_customer_id: bool = False) -> DataFrame:
    """orders ⨝ customers ⨝ products, one row per order line.

    With separate heads, customers join the heads and products the lines
    before the two meet on order_id: lines are shuffled by product (unless the
    catalogue is broadcast) and by order, never by customer."""
    c, p = shop.customers, shop.products
    customer = ["customer_id", "first_name", "region"]
    product = ["product_name", "category", "unit_price"]
    if shop.heads is not None:
        h, l = shop.heads, shop.lines
        known = h.join(c, h["customer_id"] == c["customer_id"]).select(
            h["order_id"], h["order_date"], *[c[n] for n in customer])
        priced = l.join(p, l["product_id"] == p["product_id"]).select(l["order_id"], l["quantity"], *[p[n] for n in product])
        rows = join_heads(priced, known)
    else:
        o = shop.orders
        rows = (o.join(c, o["customer_id"] == c["customer_id"]).join(p, o["product_id"] == p["product_id"])
                 .select(o["order_id"], o["order_date"], o["quantity"], *[c[n] for n in customer], *[p[n] for n in product]))
    cols = [F.col("order_id")]
    if with_customer_id:
        cols.append(F.col("customer_id").alias("cust_id"))
    cols += [F.col(n) for n in ("first_name", "region", "product_name", "category", "quantity")]
    cols += [(F.col("quantity") * F.col("unit_price")).alias("order_total"), F.col("order_date")]
    return rows.select(*cols)


def priced_lines(shop: Shop, category: str | None = None) -> DataFrame:
    """orders ⨝ products: order lines with their decimal ``order_total``.
    A category filter lands on the product scan.

    With separate heads the lines are priced first and then meet their heads
    on order_id, which leaves an order's lines together: the map-side part of
    a per-customer aggregate combines them before the next shuffle. (The other
    way round, a shuffled product join scatters them again.)"""
    p = shop.products
    if category is not None:
        p = p.filter(F.col("category") == category)
    if shop.heads is not None:
        l = shop.lines
        priced = l.join(p, l["product_id"] == p["product_id"]).select(
            l["order_id"], (l["quantity"] * p["unit_price"]).alias("order_total"))
        return join_heads(priced, shop.heads).select("order_id", "customer_id", "order_date", "order_total")
    o = shop.orders
    return o.join(p, o["product_id"] == p["product_id"]).select(
        o["order_id"], o["customer_id"], o["order_date"],
        (o["quantity"] * p["unit_price"]).alias("order_total"),
    )


def _measures():
    return [
        F.sum("order_total").alias("revenue"),
        F.count("order_id").alias("n_orders"),
        F.count("order_total").alias("n_totals"),
    ]


def customer_month_totals(shop: Shop, category: str | None = None) -> DataFrame:
    """Per (customer_id, month): revenue (decimal), n_orders = count(order_id),
    n_totals = count(order_total). Orders' own customer_id; no customer join."""
    return (priced_lines(shop, category)
            .groupBy("customer_id", month_of().alias("month"))
            .agg(*_measures()))


def customer_totals(shop: Shop, category: str | None = None,
                    customer_months: DataFrame | None = None) -> DataFrame:
    """Per customer_id: revenue, n_orders, n_totals. Re-aggregates
    ``customer_months`` when given (shared intermediate), else the lines."""
    if customer_months is not None:
        return customer_months.groupBy("customer_id").agg(
            F.sum("revenue").alias("revenue"),
            F.sum("n_orders").alias("n_orders"),
            F.sum("n_totals").alias("n_totals"),
        )
    return priced_lines(shop, category).groupBy("customer_id").agg(*_measures())


def product_quantities(shop: Shop) -> DataFrame:
    """Per product_id: summed quantity over lines whose customer exists
    (inner join on the key only, so duplicates keep their multiplicity).
    With separate heads the key check happens on them, not on the lines."""
    keys = shop.customers.select("customer_id")
    if shop.heads is not None:
        h = shop.heads
        known = h.join(keys, h["customer_id"] == keys["customer_id"]).select(h["order_id"])
        rows = join_heads(shop.lines, known)
    else:
        o = shop.orders
        rows = o.join(keys, o["customer_id"] == keys["customer_id"]).select(o["product_id"], o["quantity"])
    return rows.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))


def with_customers(totals: DataFrame, shop: Shop, *columns: str) -> DataFrame:
    """Join a per-customer pre-aggregate to the customer dimension (inner)."""
    c = shop.customers
    return totals.join(c, totals["customer_id"] == c["customer_id"]).select(
        totals["*"], *[c[name] for name in columns])


def avg_of(total: str, count: str):
    """``total / count`` in double; NULL for an empty group."""
    return F.try_divide(F.col(total).cast("double"), F.col(count).cast("double"))
