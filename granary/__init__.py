"""granary: governed content records on PySpark DataFrames."""
