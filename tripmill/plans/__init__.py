"""The jobs. These run actions and write tables; everything they compute is an
operator that can be used without them."""
