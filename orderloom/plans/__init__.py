"""End-to-end flows that read and write tables."""
