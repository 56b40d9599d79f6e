"""End-to-end plans: the Silver and Gold builds, and the mapping of the
driver's benchmark tables onto the metering domain."""
