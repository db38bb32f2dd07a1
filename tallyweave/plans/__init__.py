"""Whole computations built from operators."""
