"""Monthly demand planning and order-operations reporting as plain Spark DataFrames."""
