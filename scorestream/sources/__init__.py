"""Readers, writers and stored models."""
