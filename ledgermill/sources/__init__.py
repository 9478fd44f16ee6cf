"""Readers of exports, contract records and seed files."""
