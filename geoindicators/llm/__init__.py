"""Operators for building text corpora for model training; nothing outside this subpackage imports it."""
