"""Plans of the statement engine."""
