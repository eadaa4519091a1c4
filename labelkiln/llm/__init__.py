"""Training-data operators (one module each) and their registered queries (``queries``).

Nothing else in the library imports this package; it may import general
helpers from the rest.
"""
