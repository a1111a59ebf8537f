"""Composite table jobs and the registered queries."""
