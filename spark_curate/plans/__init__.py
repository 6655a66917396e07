"""Whole steps of a curation run, composed from the operators."""
