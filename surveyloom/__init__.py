"""Yearly survey tables on Spark: harmonise, clean, unify, and compute indicators."""
