"""Scans and streams: topic replay / Kafka, files and tables, generators."""
