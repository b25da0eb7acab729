"""Incremental file streams into tables, and change replay on top of them."""
