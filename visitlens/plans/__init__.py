"""Job plans (parameters, job runners) and the query catalog."""
