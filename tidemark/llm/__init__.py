"""Operators for building training data from document tables. Nothing outside this folder imports it."""
