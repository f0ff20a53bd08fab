"""Whole jobs composed of the operators: feature source, training, scoring, monitoring."""
