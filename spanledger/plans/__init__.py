"""Whole loads composed of operators."""
