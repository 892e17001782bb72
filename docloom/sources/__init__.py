"""Readers and writers for papers, metadata, vectors, clusters and taggings."""
