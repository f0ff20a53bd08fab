"""Table operators built from joins, groupings and windows that stay balanced on hot keys."""
