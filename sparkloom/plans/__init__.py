"""End-to-end applications and the query catalogue."""
