"""DataFrame operators, one module per stage of the retail flow."""
