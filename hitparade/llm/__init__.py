"""Training-data operators: document and conversation operators and their queries.

Nothing else in the library imports this subpackage.
"""
