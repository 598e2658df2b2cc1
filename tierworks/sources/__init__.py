"""Readers, sinks, synthetic tables and mirroring."""
