"""Jobs that chain operators: features, training, scoring, monitoring, registry."""
