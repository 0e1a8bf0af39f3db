"""The registered queries: the library run over the given test tables."""
