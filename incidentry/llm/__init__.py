"""Operators for preparing language-model training data.

Each module holds one operator with an interface of its own; ``queries``
applies them to the shared tables. Nothing outside this package imports it.
"""
