"""Whole reconciliations and reports, composed of the operators."""
