"""Readers, writers and landing of raw responses."""
