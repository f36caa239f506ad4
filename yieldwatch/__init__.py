"""Rate-series and customer-behaviour analytics on PySpark DataFrames."""
