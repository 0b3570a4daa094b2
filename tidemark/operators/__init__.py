"""Table operators: rolling features, as-of joins, metrics, drift, splits, rules."""
