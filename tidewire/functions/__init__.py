"""Columns over URLs and text."""
