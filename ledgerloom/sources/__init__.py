"""Readers: delimited text, mixed encodings, archives, landing folders."""
