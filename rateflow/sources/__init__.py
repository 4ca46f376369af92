"""Readers and writers: files, message streams, and the adapter over the star-schema tables."""
