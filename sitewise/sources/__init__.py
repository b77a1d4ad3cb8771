"""Readers and decoders for landed files."""
