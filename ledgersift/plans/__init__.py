"""Compositions: the feature table and the staged daily run."""
