"""Queries and jobs: views, reports, measures, the staged pipeline."""
