"""Wiring of the operators to the test tables."""
