"""DataFrame -> DataFrame building blocks of the marts."""
