"""Text-safety evaluation on Spark: profiling, redaction, scoring, test batteries and release gates."""
