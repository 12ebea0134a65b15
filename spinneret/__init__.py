"""Spinneret: the data side of a web crawl as Spark jobs."""
