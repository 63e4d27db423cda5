"""Bindings of the operators to the supplied test tables, and their SQL twins."""
