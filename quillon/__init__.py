"""Search-relevance analytics on Spark."""
