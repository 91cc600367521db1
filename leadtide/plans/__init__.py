"""Composed work: the pipeline over stored tables, and the registered queries."""
