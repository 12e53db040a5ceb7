"""Readers, writers, declared schemas and the shared working folder."""
