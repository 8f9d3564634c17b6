"""Column functions; every one stays a built-in Spark expression."""
