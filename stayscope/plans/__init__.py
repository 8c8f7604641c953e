"""Whole runs composed of operators."""
