"""Whole runs: several operators over shared inputs."""
