"""Name-based demographic enrichment, written as Spark DataFrame jobs."""
