"""strata.functions."""
