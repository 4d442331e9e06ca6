"""Bindings of the operators to the driver tables, each with the SQL text that checks it."""
