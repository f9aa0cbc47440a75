"""Readers, writers and file-level operators."""
