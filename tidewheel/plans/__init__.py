"""Whole jobs made of the operators (``jobs``) and the registered queries (``catalog``)."""
