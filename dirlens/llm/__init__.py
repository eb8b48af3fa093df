"""Operators for preparing training text: ten independent modules, one per operator.

Nothing else in the library imports this subpackage.
"""
