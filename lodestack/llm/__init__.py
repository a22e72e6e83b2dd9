"""Operators for preparing training data: each module holds one operator with its own general interface."""
