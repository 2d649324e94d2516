"""Readers of landed files and writers of layer tables."""
