"""Readers, storage, and the landing protocol."""
