"""Readers and writers: landed frames, typed tables, small files."""
