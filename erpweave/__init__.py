"""ERP lakehouse analytics on PySpark DataFrames."""
