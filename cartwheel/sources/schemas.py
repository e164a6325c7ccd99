"""Typed schemas of the raw layer (customers, products, orders).

Column names are lower_snake_case. Money is ``decimal(10,2)`` so sums are
exact; dates are ``date``.
"""

from __future__ import annotations

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("signup_date", T.DateType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("order_date", T.DateType()),
])

RAW_TABLES = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS}

MONEY = T.DecimalType(10, 2)

# Declared schemas of the driver's parquet test tables. Reading with a
# declared schema skips footer-based inference on every bind (and on a
# cluster keeps a stray file with a drifted schema from changing the plan).
TESTDATA = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
