"""Operators for preparing training data: tokens, secrets, chat, duplicates,
quality, mixing, packing.  Nothing else in the library imports this package."""
