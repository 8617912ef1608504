"""corpusmill.plans."""
