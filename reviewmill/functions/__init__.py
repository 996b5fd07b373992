"""Column-to-Column rules: no I/O, no UDFs, everything stays inside whole-stage codegen."""
