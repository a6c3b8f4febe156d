"""Operators for training data made of texts; nothing outside this subpackage imports it."""
