"""Operators composed from DataFrame operations."""
