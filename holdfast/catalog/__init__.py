"""Every operator as a named query over the supplied tables, with its SQL counterpart."""
