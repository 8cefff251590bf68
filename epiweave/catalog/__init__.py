"""Registered queries over the star schema, and an independent SQL statement for each."""
