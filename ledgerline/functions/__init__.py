"""JVM-side column helpers: scalar formulas, formats, id-keyed
pseudo-random values and schema expressions."""
