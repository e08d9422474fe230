"""Whole layers: compositions of operators."""
