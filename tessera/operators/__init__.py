"""Relational operators: sampling, gates, dedup, pairing, verdicts, resume, reports."""
