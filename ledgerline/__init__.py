"""Payment analytics on Spark: incremental loads, exact marts and a rolling stream view."""
