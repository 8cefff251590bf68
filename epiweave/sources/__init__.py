"""Readers of landed files, and raw-source views over the star schema."""
