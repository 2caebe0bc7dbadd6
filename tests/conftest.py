import os
import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderloom.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "orderloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny_dir():
    if not os.path.isdir(TINY):
        pytest.skip("driver tables are not present")
    return TINY


ORDER_TYPES = (
    "Order_ID string, Order_Date date, Customer_ID string, Product_ID string, Region_ID string, "
    "Quantity bigint, Unit_Price double, Revenue double, Delivery_Days bigint, Order_Status string"
)


@pytest.fixture(scope="session")
def make_orders(spark):
    """Order rows from short tuples: id, date text, customer, product, region, quantity, revenue, days."""

    def build(rows):
        full = [
            (i, date.fromisoformat(d), c, p, r, q, v / q if q else None, float(v), t,
             "Completed" if t <= 26 else "Delayed")
            for i, d, c, p, r, q, v, t in rows
        ]
        return spark.createDataFrame(full, ORDER_TYPES)

    return build


@pytest.fixture(scope="session")
def dims(spark):
    customers = spark.createDataFrame(
        [("C1", "Ann, Ltd", "OEM", None, "R1"), ("C2", "Bea", "OEM", None, "R2"),
         ("C3", "Cid", "Dealer", None, "R1"), ("C4", "Dot", "Dealer", None, "R2"),
         ("C5", "Eve", "OEM", None, "R1")],
        "Customer_ID string, Customer_Name string, Customer_Type string, Industry string, Region_ID string",
    )
    products = spark.createDataFrame(
        [("P1", "Cat A", "Line X"), ("P2", "Cat B", "Line X"), ("P3", "Cat B", "Line Y")],
        "Product_ID string, Product_Category string, Product_Line string",
    )
    regions = spark.createDataFrame(
        [("R1", "North"), ("R2", "South"), ("R3", "West")], "Region_ID string, Region string"
    )
    return customers, products, regions


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def by_key(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
