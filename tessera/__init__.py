"""tessera: a Spark-first analytics engine (DataFrame, SQL, Structured Streaming)."""
