"""Operators put together: offline preparation, stream jobs and the query catalogue."""
