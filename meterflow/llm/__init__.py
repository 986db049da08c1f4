"""Operators for preparing training data: de-duplication, licence and
toxicity scans, decontamination, search, scoring, packing and token output.

Nothing else in the library imports this subpackage.
"""
