"""Readers and writers for message topics, tables and the model artifact."""
