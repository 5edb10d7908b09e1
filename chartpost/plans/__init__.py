"""Jobs, and the registry of queries over the supplied tables."""
