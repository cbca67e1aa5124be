"""Functions of the statement engine."""
