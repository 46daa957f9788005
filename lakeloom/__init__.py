"""Commerce analytics on Spark: ingest, refine, model, check and serve behavioural event data."""
