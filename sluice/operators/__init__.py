"""Operators: cleaning (clean), constraint checks (checks), loading (load), run journal (journal)."""
