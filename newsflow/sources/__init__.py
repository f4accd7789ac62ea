"""Readers. Every reader is one lazy scan over all given paths."""
