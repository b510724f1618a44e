"""Column helpers; every one is built from JVM-side functions."""
