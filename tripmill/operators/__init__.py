"""DataFrame -> DataFrame transforms. All lazy unless a docstring says otherwise."""
