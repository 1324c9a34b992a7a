"""Fitted operators on streaming DataFrames."""
