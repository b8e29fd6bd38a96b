"""Readers, writers and codecs: files, tables and message envelopes."""
