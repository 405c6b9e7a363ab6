"""provlake: building and auditing curated scientific datasets on Spark."""
