"""Layout helpers for large or skewed groups, and the mart pipeline."""
