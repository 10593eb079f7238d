"""Readers for change files, change streams and database snapshots."""
