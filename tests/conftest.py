from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.session import local_session  # noqa: E402
from cartwheel.sources.catalog import frames_from_rows  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="cartwheel-tests-")
    session = local_session("*", 8, app_name="cartwheel-tests", extra={
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"{scratch}/checkpoints",
    })
    yield session
    session.stop()


def D(x: str) -> Decimal:
    return Decimal(x)


def day(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


# Invented sample shop. Customer 5 has no orders; order 109 names a customer
# that does not exist; order 110 names a product that does not exist; the
# two 'Mouse' products share a name; two customers are called Ana.
CUSTOMERS = [
    (1, "Ana", "Ruiz", "ana@shop.io", "North", day("2023-02-01")),
    (2, "Ben", "Ode", "ben@mail.net", "South", day("2023-03-10")),
    (3, "Cy", "Park", "cy.park@corp.co.uk", "North", day("2023-05-05")),
    (4, "Dee", "Lam", "dee@", "East", day("2023-07-07")),
    (5, "Eli", "Moss", None, "West", day("2023-09-09")),
    (6, "Ana", "Holt", "a@b@c", "South", day("2023-11-11")),
]
PRODUCTS = [
    (10, "Lamp", "Home", D("45.50")),
    (11, "Desk", "Furniture", D("250.00")),
    (12, "Mouse", "Electronics", D("19.99")),
    (13, "Monitor", "Electronics", D("199.00")),
    (14, "Mouse", "Electronics", D("25.00")),
]
ORDERS = [
    (100, 1, 11, 2, day("2024-01-15")),
    (101, 1, 13, 1, day("2024-01-20")),
    (102, 2, 12, 3, day("2024-01-31")),
    (103, 2, 14, 2, day("2024-02-01")),
    (104, 3, 10, 1, day("2024-02-14")),
    (105, 3, 13, 1, day("2024-03-03")),
    (106, 4, 12, 5, day("2024-03-15")),
    (107, 6, 11, 1, day("2024-03-31")),
    (108, 6, 10, 2, day("2024-04-01")),
    (109, 99, 13, 1, day("2024-04-02")),
    (110, 1, 77, 1, day("2024-04-03")),
]


@pytest.fixture(scope="session")
def shop(spark):
    return frames_from_rows(spark, CUSTOMERS, PRODUCTS, ORDERS)


@pytest.fixture(scope="session")
def messy_shop(spark):
    """Duplicate dimension keys and NULLs, to check that the pre-aggregated
    plans keep the row-level join's multiplicities."""
    customers = CUSTOMERS + [
        (3, "Cyra", "Park", None, "East", None),          # duplicate id, other region
        (None, "Nul", "Key", None, "North", None),
        (7, "Gus", "Null", None, None, None),            # NULL region
    ]
    products = PRODUCTS + [
        (13, "Monitor", "Electronics", D("199.00")),     # exact duplicate
        (15, "Ghost", "Electronics", None),              # NULL price
    ]
    orders = ORDERS + [
        (111, 7, 15, 2, day("2024-05-05")),
        (112, 7, 10, None, day("2024-05-06")),           # NULL quantity
        (None, 3, 11, 1, day("2024-05-07")),             # NULL order id
        (113, None, 11, 1, day("2024-05-08")),           # NULL customer
        (114, 2, 12, 1, None),                           # NULL date
    ]
    return frames_from_rows(spark, customers, products, orders)
