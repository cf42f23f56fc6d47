"""Whole jobs: scoring, training, stored models and metrics, read-side queries."""
