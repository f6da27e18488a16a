"""Readers and writers of files, artifacts and exchange formats."""
