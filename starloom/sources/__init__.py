"""Schemas, readers, writers and fixed lookup lists."""
