"""tripmart: a monthly trip lake built from Spark DataFrame jobs."""
