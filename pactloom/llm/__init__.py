"""Operators for preparing training data: near copies, fingerprints, filters, language, mixing, archives."""
