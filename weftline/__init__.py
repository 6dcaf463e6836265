"""weftline: text-corpus preparation, retrieval and evaluation as plain Spark DataFrame jobs."""
