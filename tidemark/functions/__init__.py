"""Column expressions; everything here stays inside Catalyst."""
