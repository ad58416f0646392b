"""Column-level building blocks: safe casts, scalar helpers, named predicates."""
