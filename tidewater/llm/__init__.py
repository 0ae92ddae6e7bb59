"""Operators for preparing training data; see the modules for each one's method and defined results."""
