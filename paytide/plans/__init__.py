"""Whole jobs: each chains operators between a source and a sink."""
