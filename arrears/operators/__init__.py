"""Relational and statistical operators on whole tables."""
