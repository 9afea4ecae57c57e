"""Whole flows: files to raw tables, raw tables to marts and history."""
