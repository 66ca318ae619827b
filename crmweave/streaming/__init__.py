"""Staged files as they land, through the same plans."""
