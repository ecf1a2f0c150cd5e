"""DataFrame-level operators: fills, medians, encoders, joins, ranks, learning, drift."""
