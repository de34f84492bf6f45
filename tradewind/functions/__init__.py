"""Column functions: every one maps Column to Column and stays inside codegen."""
