"""Readers, writers and persistence of fitted objects."""
