"""Readers and writers for each layer, the warehouse export and shared scratch space."""
