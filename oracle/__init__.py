"""DuckDB oracle: ANSI SQL over the driver tables, written from the
reference's semantics (adapters in a WITH clause, then the mart)."""
