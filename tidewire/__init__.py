"""Ingest and index of news stories as Spark jobs."""
