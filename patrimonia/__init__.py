"""Spark jobs for public asset and income disclosures."""
