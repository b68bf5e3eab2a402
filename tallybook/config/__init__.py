"""Per-service settings. Service names appear here and nowhere else in the library."""
