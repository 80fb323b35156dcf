"""Table-agnostic DataFrame operators (each returns a lazy DataFrame; guards return or raise)."""
