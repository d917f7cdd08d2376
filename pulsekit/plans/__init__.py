"""Composed jobs: the query registry, its SQL oracle, and the flagship report job."""
