"""Operators: staging projections, metric marts, lifecycle rules, experiment statistics."""
