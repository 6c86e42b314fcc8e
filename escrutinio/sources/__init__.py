"""Readers: message streams, relational tables, coordinate and geometry files."""
