"""Whole pipelines: from landed rows to dimensions and facts."""
