"""Whole flows composed of operators: dimension load, readings load, analytics."""
