"""Column builders. Everything here returns a pyspark ``Column`` (JVM-side, codegen'd)."""
