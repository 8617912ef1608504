"""corpusmill.operators."""
