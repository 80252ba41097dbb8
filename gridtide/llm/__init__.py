"""Operators for the preparation of training text, each on whole tables of documents."""
