"""Commerce event analytics as DataFrame operators shared by batch and streams."""
