"""Streaming variants of commutative roll-ups. An extension: batch and stream share the same aggregates."""
