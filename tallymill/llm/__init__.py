"""Operators for building language-model training data from web-scale tables."""
