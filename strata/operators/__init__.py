"""strata.operators."""
