"""Readers, writers, the refresh manifest and the table layers."""
