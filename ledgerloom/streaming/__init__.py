"""Streaming of the statement engine."""
