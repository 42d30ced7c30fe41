"""Query plans over the driver's tables: fixture views and the registry."""
