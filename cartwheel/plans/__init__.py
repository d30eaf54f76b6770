"""Composed batch jobs and the registry of checked queries."""
