"""Readers, integrity gates and writers."""
