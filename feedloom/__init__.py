"""Feed curation and training-data preparation on Spark DataFrames."""
