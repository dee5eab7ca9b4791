"""Scoring in batch and as a stream."""
