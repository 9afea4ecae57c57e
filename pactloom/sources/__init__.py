"""Readers for landed files and warehouse tables."""
