"""Whole-corpus plans and the registered queries."""
