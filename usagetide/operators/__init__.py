"""Analysis, causal, survival, scoring and portfolio operators."""
