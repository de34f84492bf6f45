"""Loads from streams."""
