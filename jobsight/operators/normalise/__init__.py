"""Source normalisers: raw payload tables to canonical job/course records."""

from .catalog import catalog  # noqa: F401
