"""Operators of a training-data pipeline: near copies, mixing, licences, filters, secrets, tokens, leaks, languages."""
