"""Readers, writers and domain views."""
