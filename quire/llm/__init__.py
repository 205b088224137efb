"""Operators for preparing training corpora. Nothing else in quire imports this subpackage."""
