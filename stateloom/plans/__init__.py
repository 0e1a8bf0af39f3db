"""Derived tables: pure functions of inputs and a block range."""
