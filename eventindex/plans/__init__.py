"""Compositions: building an index, and the calls users make on it."""
