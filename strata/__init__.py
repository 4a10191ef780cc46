"""strata: keep analytical tables up to date from changing source files, on plain Spark and Parquet."""
