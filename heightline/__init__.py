"""Block-stream analytics as composable Spark DataFrame functions."""
