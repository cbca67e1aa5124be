"""Operators of the statement engine."""
