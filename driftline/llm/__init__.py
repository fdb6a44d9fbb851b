"""Corpus operators for training data: scans, archives, filters, de-duplication, search and encoding."""
