"""Readers: print-page text files and grid tables."""
