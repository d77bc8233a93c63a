"""Tag mining over text posts, written as Spark DataFrame operators."""
