"""Whole pipelines, from raw tables to checked analytics tables."""
