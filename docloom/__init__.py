"""docloom: document clustering, topics and cluster search as Spark DataFrame jobs."""
