"""Column expressions: no job, no shuffle, only what Catalyst can compile."""
