"""Column expressions: every function takes and returns `Column`s and stays inside the JVM."""
