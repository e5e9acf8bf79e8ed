"""Readers and writers of documents, pages, catalogs and metadata."""
