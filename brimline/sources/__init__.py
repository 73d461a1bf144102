"""Readers, writers and layouts."""
