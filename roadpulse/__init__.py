"""Vehicle telemetry analytics on Spark: ingest, behaviour summaries, speed windows, alerts."""
