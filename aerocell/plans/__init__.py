"""Composed pipelines, derived test inputs and the registered queries."""
