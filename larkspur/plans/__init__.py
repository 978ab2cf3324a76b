"""Operators bound to the test tables, each with its SQL check where SQL can express it."""
