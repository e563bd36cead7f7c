"""Layered (bronze, silver, gold) warehouse operators on Spark DataFrames."""
