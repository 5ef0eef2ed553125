"""Column helpers. Everything here is a JVM-side expression; there are no Python UDFs."""
