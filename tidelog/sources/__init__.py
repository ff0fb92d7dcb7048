"""Readers, each for batch and stream frames where both exist."""
