"""Compositions of the operators: layers, jobs, checks and the registered queries."""
