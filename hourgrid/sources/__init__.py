"""Reading raw streams, writing tables, and the binding of the supplied tables to observations."""
