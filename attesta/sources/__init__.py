"""Readers. Files are always read with an explicit schema."""
