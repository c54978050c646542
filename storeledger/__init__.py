"""Store-sales files to validated tables, metrics and reports, on Spark."""
