"""Readers and writers: tables, streams, the keyed log and city lists."""
