"""Document triage on Spark: rules compiled to column expressions, one inventory row per document."""
