"""Operators for preparing training data for language models.

Nothing outside this folder imports it. ``queries`` registers one thin query per
operator; the operators themselves keep general interfaces.
"""
