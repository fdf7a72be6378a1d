"""Operators for training text and record linkage; imported by nothing else in the package."""
