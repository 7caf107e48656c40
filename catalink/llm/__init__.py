"""Operators for training data: names, survivors, components, linkage, leakage, mixing, spans."""
