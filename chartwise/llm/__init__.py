"""Operators for preparing text corpora: one module per operator, no import from the rest of the library."""
