"""The engine's operators run on the driver's star-schema tables."""
