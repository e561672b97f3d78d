"""sieveline: evidence matching and training-data preparation on Spark DataFrames."""
