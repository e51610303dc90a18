"""Whole jobs as batch plans."""
