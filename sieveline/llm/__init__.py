"""Operators for training data."""
