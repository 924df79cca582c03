"""DataFrame-to-DataFrame operators. Each is lazy unless its docstring says that it runs a job."""
