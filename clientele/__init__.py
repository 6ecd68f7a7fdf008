"""Customer-relationship data on Spark: ingest, merge, validate, analyse, export."""
