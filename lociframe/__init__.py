"""Genomic interval and expression analytics on DataFrames."""
