"""Event enrichment and layered lake tables, written as Spark DataFrame code."""
