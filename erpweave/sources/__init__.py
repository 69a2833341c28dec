"""Readers, writers and extraction control."""
