"""Event ETL, data-quality and reporting operators on Spark DataFrames."""
