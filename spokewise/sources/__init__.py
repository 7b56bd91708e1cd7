"""Readers for tables and saved models."""
