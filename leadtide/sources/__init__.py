"""Inputs: stored tables, posting batches, the technology config, benchmark bindings."""
