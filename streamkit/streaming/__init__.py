"""Sink specifications, triggers and query control for Structured Streaming."""
