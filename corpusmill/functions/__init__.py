"""corpusmill.functions."""
