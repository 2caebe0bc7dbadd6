"""Declared schemas of the five input tables; nothing is ever inferred."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_text, _long, _double, _date = T.StringType(), T.LongType(), T.DoubleType(), T.DateType()

SALES_ORDERS = _struct(
    Order_ID=_text, Order_Date=_date, Customer_ID=_text, Product_ID=_text, Region_ID=_text,
    Quantity=_long, Unit_Price=_double, Revenue=_double, Delivery_Days=_long, Order_Status=_text,
)
CUSTOMERS = _struct(
    Customer_ID=_text, Customer_Name=_text, Customer_Type=_text, Industry=_text, Region_ID=_text
)
PRODUCTS = _struct(Product_ID=_text, Product_Category=_text, Product_Line=_text)
REGIONS = _struct(Region_ID=_text, Region=_text)
FORECAST = _struct(
    Month=_date, Product_ID=_text, Region_ID=_text, Actual_Demand=_long, Naive_Forecast=_double,
    Seasonal_Naive_Forecast=_double, Forecast_Demand=_double, Forecast_Error=_double,
    Absolute_Error=_double, Squared_Error=_double,
)

TABLES = {
    "sales_orders": SALES_ORDERS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "regions": REGIONS,
    "model_forecast_results": FORECAST,
}
