"""Publishing and export of results."""
