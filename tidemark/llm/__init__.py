"""Operators for preparing text corpora at scale.

Operators, each in a module of its own, plus ``registry`` with the
queries that apply them to the driver's tables. Nothing else in the library
imports this subpackage.
"""
