"""Staging, star schema, data products and the interval run."""
