"""Readers, writers, schemas and the star-schema adapter."""
