"""Dataflow operators: pure DataFrame to DataFrame functions."""
