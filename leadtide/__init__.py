"""Job-posting analytics on Spark: ingest, clean, detect technologies, score, report."""
