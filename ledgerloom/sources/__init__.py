"""Sources of the statement engine."""
