"""Bounded and unbounded inputs."""
