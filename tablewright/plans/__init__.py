"""Whole workflows and the query registry."""
