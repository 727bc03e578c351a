"""plumbline: data standardisation and quality operators for PySpark DataFrames."""
