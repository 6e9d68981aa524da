"""Composed plans and the registered queries over the test tables."""
