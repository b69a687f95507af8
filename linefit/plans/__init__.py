"""Whole programs put together from the operators, and the table shapes they work on."""
