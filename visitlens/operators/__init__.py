"""DataFrame operators: sessions, sampling (extract), categories, funnel, areas, ads,
keyed merges, and join helpers (size-checked broadcast, salted join for hot keys)."""
