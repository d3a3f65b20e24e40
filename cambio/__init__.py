"""Market-quote warehouse on Spark: landed quote documents in, current-quote star schema and alerts out."""
