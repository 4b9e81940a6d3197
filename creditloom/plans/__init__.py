"""Whole jobs: stages that read, transform and write, training, scoring, monitoring."""
