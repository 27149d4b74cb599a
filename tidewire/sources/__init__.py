"""Readers and writers of the formats that stories come and go in."""
