"""Customer analytics over logistics exports, on PySpark."""
