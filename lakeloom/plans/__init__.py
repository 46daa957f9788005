"""SQL models written once for two dialects, and the registry of queries."""
