"""Reusable DataFrame jobs: dedup, keyed sequences, versions, global order, upsert, checks, layout."""
