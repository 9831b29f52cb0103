"""Extraction of messy spreadsheet tables as Spark dataflows."""
