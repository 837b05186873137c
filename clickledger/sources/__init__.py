"""Inputs: driver tables, shapes derived from them, warehouse tables."""
