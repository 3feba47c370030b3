"""Operators for preparing training data; see the module of each."""
