"""DataFrame -> DataFrame operators, one module per pipeline layer."""
