"""Readers: staged stream files, id maps, tenant configuration."""
