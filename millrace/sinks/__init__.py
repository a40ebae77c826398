"""Writers.  Nothing passes through the driver."""
