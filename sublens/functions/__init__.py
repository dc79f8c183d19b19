"""Column-level rules and helpers; all of them stay inside whole-stage code generation."""
