"""Operators for preparing training text: sharding, packing, filtering, scanning, classifying.

Nothing else in the library imports this package.
"""
