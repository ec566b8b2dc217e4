"""Graph analytics and dataflow operators on PySpark DataFrames."""
