"""Readers and discovery."""
