"""Posting batches picked up as files arrive."""
