"""Readers; each gives the same columns whatever the files lack or have besides."""
