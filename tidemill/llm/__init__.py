"""Operators for preparing training text: search, decontamination, extraction, classification, sharding and packing."""
