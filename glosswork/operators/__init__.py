"""Table operators: layout, line roles, ordered assembly, gates, witness comparison, search."""
