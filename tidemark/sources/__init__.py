"""Readers and writers for the raw, trusted and mart layers."""
