"""veilscan: a Spark engine that finds, scores and reports personal data in documents and tables."""
