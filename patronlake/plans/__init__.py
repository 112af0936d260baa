"""Whole jobs: the transform run and the serving queries."""
