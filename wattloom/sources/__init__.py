"""Readers for files, archives and message topics."""
