"""kinloom: entity resolution and corpus preparation on Spark DataFrames."""
