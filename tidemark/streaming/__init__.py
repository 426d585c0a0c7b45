"""Continuous variants of the batch jobs."""
