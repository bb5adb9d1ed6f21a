"""Readers and writers of the store and of delivered files."""
