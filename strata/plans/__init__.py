"""Plans that compose operators: stand-in tables and end-to-end jobs."""
