"""Operators for building training data at scale, and their queries."""
