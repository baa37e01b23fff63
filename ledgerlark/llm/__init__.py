"""Operators for building training corpora: filters, scans, formats, encodings, search and mixing."""
