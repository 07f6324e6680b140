"""Readers and writers. Each reader pairs a parser over a ``value`` column of lines
with a function that reads files, so the same parsing works on any text column."""
