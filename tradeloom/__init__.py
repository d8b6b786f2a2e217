"""Sales analytics on Spark DataFrames: ingest, quality, star schema, aggregates, measures."""
