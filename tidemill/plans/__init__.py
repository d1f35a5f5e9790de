"""Complete jobs over the supplied tables, each with its SQL counterpart where SQL can say it."""
