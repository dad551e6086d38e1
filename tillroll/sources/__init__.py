"""Readers and writers of transaction files, holiday files and reject files."""
