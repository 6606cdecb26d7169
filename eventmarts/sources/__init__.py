"""Readers and writers: raw lines, typed topics, keyed tables, cursors."""
