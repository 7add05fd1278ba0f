"""No operator of this library is incremental: every input is a finished table, so
nothing streams.  The package is kept as the place where a streaming source would go."""
