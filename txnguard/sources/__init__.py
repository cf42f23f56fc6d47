"""Readers for files, streams and account lists, and the event encoder."""
