"""Operators for large training-corpus preparation. Nothing else in the package imports this one."""
