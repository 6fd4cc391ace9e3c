"""Readers and writers: stage files, the annotated corpus and the warehouse."""
