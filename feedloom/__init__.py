"""feedloom: a Spark-first batch engine for feed ranking, enrichment and corpus preparation."""
