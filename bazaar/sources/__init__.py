"""Landed files in, tables and exports out."""
