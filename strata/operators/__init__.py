"""strata operators."""
