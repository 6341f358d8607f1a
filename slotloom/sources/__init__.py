"""Readers and writers: documents, manifests, templates, answer keys, lexicons, features, models."""
