"""Jobs composed of operators: conformed sources, the master table and its summary."""
