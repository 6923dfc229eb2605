"""Column -> Column building blocks. All of them run inside whole-stage codegen."""
