"""Table maintenance, event-time windows, joins, de-duplication, quality and audits."""
