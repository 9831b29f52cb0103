"""Cells from relations and from workbook files."""
