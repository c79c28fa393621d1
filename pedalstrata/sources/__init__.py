"""Readers, writers and shared-storage staging."""
