"""Relational operators over cells and rectangles."""
