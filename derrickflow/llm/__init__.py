"""Operators for training text: packing, mixing, quality. Nothing outside this subpackage imports it."""
