"""Readers and writers: file drops, typed layouts, partition publishing."""
