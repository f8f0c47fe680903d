"""Readers, writers and generated grids."""
