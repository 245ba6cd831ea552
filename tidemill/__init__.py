"""tidemill: an online shop's lakehouse, analytics, change and stream jobs as plain PySpark functions."""
