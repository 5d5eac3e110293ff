"""Training-data operators: tokens, packing, duplicate and benchmark removal, scoring.

Nothing outside this subpackage imports it. ``catalog`` holds its registered queries.
"""
