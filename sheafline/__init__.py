"""Document analytics on Spark: documents, pages, stage runs and model answers as DataFrames."""
