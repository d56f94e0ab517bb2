"""Readers and writers: driver tables, CSV with explicit schema, checkpoints."""
