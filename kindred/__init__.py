"""Cross-domain recommendation analytics as plain Spark DataFrame operators."""
