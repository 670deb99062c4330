"""The operators run over the shared test tables, with matching SQL."""
