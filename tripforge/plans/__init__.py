"""Whole-job plans composed from the operators."""
