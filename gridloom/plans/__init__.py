"""Dataflows: detection, structure, cleaning and export of tables."""
