"""Composed jobs: the cleaning pipelines (C30-C32) and the report / dashboard tables."""
