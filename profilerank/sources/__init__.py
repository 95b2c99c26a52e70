"""Readers and writers of pools, score files, response caches and rankings."""
