"""E-commerce revenue and marketing analytics expressed as Spark DataFrames."""
