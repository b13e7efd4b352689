"""Spark jobs that turn stored sitemaps and law pages into enriched law documents."""
