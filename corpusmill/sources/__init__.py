"""corpusmill.sources."""
