"""Batch writers; streaming sinks live in ``wattloom.streaming``."""
