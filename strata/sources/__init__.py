"""strata.sources."""
