"""Reading, naming, typing and checking of source tables."""
