"""Operators bound to the shared tables, each beside its SQL oracle."""
