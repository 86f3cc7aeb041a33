"""Training-data operators over a ``documents`` table (text in, decisions out).

Nothing else in the library imports this subpackage; removing it leaves the
rest working.  Each module holds one operator; ``queries`` registers them.
"""
