"""Whole layered runs: raw files to cleaned tables to a star."""
