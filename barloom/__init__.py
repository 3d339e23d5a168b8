"""barloom: panel time-series, screening and learning operators on Spark DataFrames."""
