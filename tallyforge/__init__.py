"""DataFrame operators for tabular learning and ranking analytics on Spark."""
