"""Keyed state over event streams."""
