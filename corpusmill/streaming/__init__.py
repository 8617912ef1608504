"""corpusmill.streaming."""
