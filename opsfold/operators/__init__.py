"""Relational operators: enrichment, ordered scans, sessions, roll-ups,
attribution, anomalies, the skew study and exact row limits."""
