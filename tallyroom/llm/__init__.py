"""Operators for preparing training data, and their queries."""
