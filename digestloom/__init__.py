"""Article digests on Spark: ingest, keywords, summaries, posts and corpus views."""
