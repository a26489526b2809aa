"""Whole jobs: the batch run and the reports."""
