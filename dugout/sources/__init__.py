"""Readers, writers and declared tables."""
