"""DataFrame operators: preparation, positions, joins, vectors, metrics and ML."""
