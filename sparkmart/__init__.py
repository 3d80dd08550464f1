"""sparkmart: an analytics-warehouse operator library on PySpark."""
