"""Transformations between the layers: silver, gold, serving, checks, profiles."""
