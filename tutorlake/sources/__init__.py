"""Readers: raw logs, warehouse tables, column views over them, and stream inputs."""
