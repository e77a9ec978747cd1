"""Training-data operators: ten corpus jobs over ``documents``, ``pages`` and ``conversations``.

Nothing else in the library imports this subpackage.
"""
