"""Transaction-risk analytics written as Spark DataFrame operators."""
